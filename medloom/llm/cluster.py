"""Shared helpers of the operators: checkpoints, checked broadcasts, bounded samples, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.session import written

# A side with at most this many narrow rows (a few numbers each) is broadcast, after counting it.
BROADCAST_ROWS = 200_000


def saved(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read on from there; survives lost executors."""
    return written(df)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it holds at most ``most`` rows; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that ``df`` has no column of; names differ by more than case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def share_of_hash(key: Column, share: float) -> Column:
    """A deterministic choice of ``share`` of the keys."""
    return F.pmod(F.xxhash64(F.lit("share"), key), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the smallest node of its component.

    Alternates large-star and small-star steps, which keep components and need O(log n) rounds. A step groups by node and only
    takes minima, so a hub is pre-aggregated and never held in one place. Each round is checkpointed.
    """
    current = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    previous = None
    for _ in range(rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node go to the smallest node of its neighbourhood
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small_step = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        current = saved(small_step.where("a <> b").distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == previous:
            return current.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        previous = state
    raise RuntimeError("components did not settle")
