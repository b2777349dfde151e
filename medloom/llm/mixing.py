"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. A source's budget is met by all documents below a hash threshold, so a smaller
budget always takes a subset of a larger one. The threshold is found without sorting: sum sizes by source and leading hash
digits, find the bucket in which the budget ends, and refine only that bucket by the next digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.cluster import saved, small

DIGITS = 15  # hexadecimal digits of the hash
STEP = 3  # digits by which a bucket is refined: 4,096 buckets
MOST_REPEATS = 3
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def document_hash(doc_id: Column, text: Column) -> Column:
    """Leading digits of MD5 over id and text; rows equal in both share a hash and are taken together."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.substring(F.md5(key), 1, DIGITS)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash); sizes are words, null text has none."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id"), F.col("text")).alias("hash")
    )


def cycled_weights(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights repeat over the sources in code-point order, null last. One row per source, not per document."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    return totals.withColumn("weight", pick.cast("long"))


def targets(totals: DataFrame, share: int = 100) -> DataFrame:
    """Add ``target``: ``share`` percent of all sizes split by weight, no source above ``MOST_REPEATS`` times its size.

    Giving a capped source's excess back to the others by weight until none is above its cap settles at one common level:
    target = least(cap, level * weight). Sorted by cap / weight, the capped sources are a prefix, so one running sum finds
    the level exactly from whole numbers: it is the first that fits, and later ones are lower.
    """
    t = totals.withColumn("cap", F.col("source_size") * MOST_REPEATS)
    ratio = F.col("cap") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0))
    free = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    budget = F.sum("source_size").over(every) * share
    level = (budget - capped * 100).cast("double") / (free * 100)
    t = t.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    t = t.withColumn("level", F.max(fits).over(every))
    return t.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    ).drop("cap", "level")


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: ``whole`` repeats for all documents and ``cut``, the hash below which documents are taken once more.

    ``rows`` has (source, size, hash), ``plan`` (source, source_size, target). The document (or the equal rows) in which the
    budget ends is taken if that brings the source nearer to its target. Each round reads only what fell into the boundary
    bucket of its source; a source leaves when its bucket holds a single hash.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = plan.select("source", whole.alias("whole"), F.col("source_size"), "target").withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    state = state.select("source", "whole", "rest", F.lit("").alias("cut"))
    done, width = None, 0
    while width < DIGITS:
        width += STEP
        inside = rows.alias("r").join(
            small(state).alias("s"),
            F.col("r.source").eqNullSafe(F.col("s.source")) & (F.substring("r.hash", 1, width - STEP) == F.col("s.cut")),
        )
        buckets = inside.groupBy(
            "s.source", "s.whole", "s.rest", F.substring("r.hash", 1, width).alias("bucket")
        ).agg(F.sum("r.size").alias("mass"), F.min("r.hash").alias("low"), F.max("r.hash").alias("high"))
        upto = Window.partitionBy("source").orderBy("bucket")
        buckets = buckets.withColumn("before", F.sum("mass").over(upto) - F.col("mass"))
        # the last bucket that begins at or below the budget; empty budgets end in the first bucket
        edge = buckets.where(F.col("before") <= F.col("rest")).groupBy("source", "whole", "rest").agg(
            F.max(F.struct("bucket", "before", "mass", "low", "high")).alias("b")
        )
        edge = saved(edge.select("source", "whole", "rest", "b.*"))
        single = (F.col("low") == F.col("high")) | F.lit(width >= DIGITS)
        taken = F.col("mass") <= 2 * (F.col("rest") - F.col("before"))
        cut = F.when(taken, F.concat("high", F.lit("~"))).otherwise(F.col("low"))
        ended = edge.where(single).select("source", "whole", cut.alias("cut"))
        done = ended if done is None else done.union(ended)
        state = edge.where(~single).select("source", "whole", (F.col("rest") - F.col("before")).alias("rest"), F.col("bucket").alias("cut"))
        if state.isEmpty():
            break
    return done


def cuts_of(rows: DataFrame, weights: tuple[int, ...], share: int) -> DataFrame:
    """(source, source_size, weight, target, whole, cut), one row per source."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = saved(targets(cycled_weights(totals, weights), share))
    cuts = thresholds(rows, plan)
    same = F.col("p.source").eqNullSafe(F.col("c.source"))
    return saved(plan.alias("p").join(cuts.alias("c"), same, "left").select("p.*", "c.whole", "c.cut"))


def _counted(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    once_more = (F.col("_hash") < F.col("c.cut")).cast("long")
    joined = rows.alias("r").join(small(cuts).alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")))
    copies = F.least(F.lit(MOST_REPEATS), F.col("c.whole") + once_more).cast("long")
    return joined.select("r.*", "c.source_size", "c.target", copies.alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = 100) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    ``copies`` is how often the mix repeats the document, 0 to 3. Null and empty texts have size 0; a null source is a source
    of its own. Rows equal in id and text are taken alike. An empty table gives no rows. Other columns are ignored.
    """
    rows = saved(sized(docs))
    counted = _counted(rows.withColumnRenamed("hash", "_hash"), cuts_of(rows, weights, share))
    return counted.drop("_hash").withColumn("taken", F.col("size") * F.col("copies"))


def sample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = 100) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, whatever their names, each as often as the mix takes it.

    Nulls, empty texts, repeated rows and empty tables are as in :func:`mix`; rows without words are not taken where their source
    has none.
    """
    cuts = cuts_of(saved(sized(docs)), weights, share)
    # the given columns travel as one struct, so no name of theirs can clash
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    hashed = docs.select(whole, docs["source"].alias("source"), document_hash(docs["doc_id"], docs["text"]).alias("_hash"))
    taken = _counted(hashed, cuts).where("copies > 0")
    taken = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return taken.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
