"""Approximate nearest neighbours by inner product: hierarchical k-means tree, best-bin-first traversal.

The tree is fitted on a bounded sample; every vector is put into its leaf. A query visits leaves in the order in which a
priority queue over the tree's nodes yields them. How many leaves are visited is widened until a calibration set, searched
exactly over all vectors, finds the wanted share of its true neighbours. Full leaves are split into blocks, so that neither a
popular leaf nor a popular vector meets one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.cluster import saved

MOST_SAMPLE = 20_000  # vectors the tree is fitted on
BRANCHES = 12
LEAF_SAMPLE = 60  # sampled vectors in a leaf, at most
CALIBRATION = 64  # queries searched exactly
TARGET_RECALL = 0.97
BLOCK = 4_000  # vectors, and queries, that meet in one group
BUNDLES = 64  # neighbouring leaves are dealt out together, so that a query answers once for each bundle it visits


class Tree:
    """Nodes in arrays; ``leaf[i]`` is a leaf's number or -1."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.centre: list[np.ndarray] = []
        self.spread: list[float] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._build(x, np.random.default_rng(seed))
        self.centres = np.array(self.centre)
        self.spreads = np.array(self.spread)

    def _build(self, x: np.ndarray, rng: np.random.Generator) -> int:
        me = len(self.centre)
        mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        self.centre.append(mean)
        self.spread.append(float(np.sqrt(((x - mean) ** 2).sum(axis=1).mean())) if len(x) else 0.0)
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(x, rng) if len(x) > LEAF_SAMPLE else []
        if len(parts) < 2:
            self.leaf[me] = self.leaves
            self.leaves += 1
        else:
            self.children[me] = [self._build(p, rng) for p in parts]
        return me

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
        distinct = np.unique(x, axis=0)
        if len(distinct) < 2:
            return []
        centres = distinct[rng.choice(len(distinct), min(BRANCHES, len(distinct)), replace=False)]
        for _ in range(8):
            near = (x @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
            centres = np.array([x[near == k].mean(axis=0) for k in range(len(centres)) if (near == k).any()])
        near = (x @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
        return [x[near == k] for k in range(len(centres)) if (near == k).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every vector: down to the nearest centre."""
        out = np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            c = self.centres[kids]
            near = (x[rows] @ c.T - 0.5 * (c**2).sum(axis=1)).argmax(axis=1)
            stack += [(kid, rows[near == k]) for k, kid in enumerate(kids) if (near == k).any()]
        return out

    def visit(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first: by inner product with the centre plus what the spread may add."""
        size = float(np.sqrt(q @ q))
        worth = self.centres @ q + size * self.spreads
        heap = [(-worth[0], 0)]
        out: list[int] = []
        while heap and len(out) < most:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            else:
                for kid in self.children[node]:
                    heapq.heappush(heap, (-worth[kid], kid))
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>): rows that take part. Of rows that share an id the least vector counts; null ids do not."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _best(scores: np.ndarray, exact, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact scores of the k best, ties to the smaller id. Matrix products round equal vectors differently, so all
    that come near the k-th are scored again one by one."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge - 1e-9 * max(1.0, abs(edge)))
    else:
        near = np.arange(len(scores))
    value = exact(near)
    order = np.lexsort((ids[near], -value))[:k]
    return near[order], value[order]


def _top(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for every usable row that meets the condition ``queries`` its k nearest among the others.

    Score: inner product in double precision. Null, zero and non-finite vectors, and those of another width than the most
    frequent, neither ask nor answer. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    good = saved(usable(vectors))
    widths = good.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None:
        return empty
    width, total = widths["w"], widths["count"]
    good = good.where(F.size("v") == width)
    share = min(1.0, MOST_SAMPLE / total)
    part = F.pmod(F.xxhash64(F.lit("tree"), "vec_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = good.where(part).orderBy("vec_id").select("v").toArrow()  # bounded by MOST_SAMPLE, give or take
    tree = Tree(_matrix(sample.column("v"), width) if sample.num_rows else np.zeros((1, width)))
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.assign(_matrix(batch.column("v"), width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "v", "leaf"])

    placed = saved(good.mapInArrow(assign, "vec_id bigint, v array<double>, leaf bigint"))
    asked = placed.where(queries)
    visits = _calibrated(placed, asked, tree, shared, width, k)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, bundles, leaves = [], [], []
                for i, q in enumerate(_matrix(part.column("v"), width)):
                    seen = np.sort(np.array(shared.value.visit(q, visits)))
                    mine, first = np.unique(seen * BUNDLES // shared.value.leaves, return_index=True)
                    rows += [i] * len(mine)
                    bundles += mine.tolist()
                    leaves += [p.tolist() for p in np.split(seen, first[1:])]
                took = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(took),
                        part.column("v").take(took),
                        pa.array(bundles, pa.int64()),
                        pa.array(leaves, pa.list_(pa.int64())),
                    ],
                    ["query_id", "q", "bundle", "leaves"],
                )

    ways = asked.select("vec_id", "v").mapInArrow(visit, "query_id bigint, q array<double>, bundle bigint, leaves array<bigint>")
    ways = saved(ways)
    placed = placed.withColumn("bundle", F.floor(F.col("leaf") * BUNDLES / F.lit(tree.leaves)).cast("long"))
    per_bundle = placed.groupBy("bundle").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    asks = ways.groupBy("bundle").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns"))
    plan = F.broadcast(saved(per_bundle.join(asks, "bundle")))  # at most BUNDLES rows
    salt = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    right = placed.join(plan, "bundle").select(
        "bundle", salt("vec_id", F.col("blocks")).alias("block"), every("turns").alias("turn"), "vec_id", "v", "leaf"
    )
    left = ways.join(plan, "bundle").select(
        "bundle", every("blocks").alias("block"), salt("query_id", F.col("turns")).alias("turn"), "query_id", "q", "leaves"
    )

    def score(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(xs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q, x = np.stack(qs["q"].to_numpy()), np.stack(xs["v"].to_numpy())
        ids, leaf, asks = xs["vec_id"].to_numpy(), xs["leaf"].to_numpy(), qs["query_id"].to_numpy()
        found: list[tuple[np.ndarray, ...]] = []
        step = max(1, 200_000 // len(x))  # bounds what is scored at once, ties included
        for at in range(0, len(q), step):
            products = q[at : at + step] @ x.T
            products[asks[at : at + step, None] == ids] = -np.inf
            for i, leaves in enumerate(qs["leaves"].iloc[at : at + step]):
                products[i, ~np.isin(leaf, leaves)] = -np.inf
            edge = np.partition(products, -k, axis=1)[:, -k, None] if len(x) > k else np.full((len(products), 1), -np.inf)
            # matrix products round equal vectors differently: all that come near the k-th are scored again one by one
            near = np.isfinite(products) & (products >= edge - np.where(np.isfinite(edge), 1e-9 * np.maximum(1.0, np.abs(edge)), 0.0))
            row, col = np.nonzero(near)
            value = (x[col] * q[at + row]).sum(axis=1)
            order = np.lexsort((ids[col], -value, row))
            row, col, value = row[order], col[order], value[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            found.append((asks[at + row[place < k]], ids[col[place < k]], value[place < k]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    key = ["bundle", "block", "turn"]
    scored = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(score, "query_id bigint, vec_id bigint, score double")
    return _top(scored, k).select("query_id", "rank", "vec_id", "score")


def _calibrated(placed: DataFrame, asked: DataFrame, tree: Tree, shared, width: int, k: int) -> int:
    """Leaves to visit so that calibration queries find TARGET_RECALL of their true neighbours among all vectors."""
    chosen = asked.orderBy(F.xxhash64(F.lit("calibrate"), "vec_id"), "vec_id").limit(CALIBRATION).select("vec_id", "v").toArrow()
    if not chosen.num_rows or tree.leaves == 1:
        return 1
    q = _matrix(chosen.column("v"), width)
    names = chosen.column("vec_id").to_numpy()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [[] for _ in names]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            x = _matrix(batch.column("v"), width)
            products = q @ x.T
            for i, me in enumerate(names):
                near, value = _best(products[i], lambda near: (x[near] * q[i]).sum(axis=1), ids, k + 1)
                found = [(-s, int(n), int(b)) for s, n, b in zip(value, ids[near], leaf[near]) if n != me]
                best[i] = heapq.nsmallest(k, best[i] + found)
        flat = [(int(names[i]), n, b, -s) for i, own in enumerate(best) for s, n, b in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[c] for f in flat], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
            ["query_id", "vec_id", "leaf", "score"],
        )

    scanned = placed.select("vec_id", "v", "leaf").mapInArrow(scan, "query_id bigint, vec_id bigint, leaf bigint, score double")
    truth = _top(scanned, k).select("query_id", "leaf").toPandas()
    rank = {int(me): {b: i for i, b in enumerate(tree.visit(row, tree.leaves))} for me, row in zip(names, q)}
    needed = np.array([rank[a][b] + 1 for a, b in zip(truth["query_id"], truth["leaf"])])
    if not len(needed):
        return 1
    return int(np.quantile(needed, TARGET_RECALL, method="higher"))
