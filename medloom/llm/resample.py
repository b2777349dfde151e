"""Importance resampling towards a target distribution of hashed n-grams, with Arrow kernels.

A chunk of texts is lowered (A-Z bytes by a table), cut (``split_pattern_regex``), flattened and dictionary-encoded. Word n-grams are
pairs of (index of the shorter n-gram, shifted word index), made dense by another dictionary, so the CRC of an n-gram is taken
once for every distinct pair of a chunk: it goes on from the CRC of the shorter one. Bucket counts and document weights are then
``take`` and segment sums over indices. Bucket counts of both sides are summed in Spark (at most BUCKETS rows each); gains are an
array of BUCKETS numbers. Ranks come from one range-partitioned, written sort: position in the partition plus the rows before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X
from medloom.llm.cluster import saved

BUCKETS = 10_000
LONGEST = 1  # words of the longest n-gram
SEED = "2024"
MIN_WORDS = 20  # documents with fewer words are never drawn
PERCENT = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Features:
    """N-grams of the texts of a chunk: ``bucket[index]`` are the buckets, ``row`` their text, ``words`` the words of each text."""

    def __init__(self, texts: pa.Array, buckets: int, longest: int):
        # lowered on buffers of its own that begin at 0: string kernels misread a slice whose cast keeps its first offset
        data, offsets = X.buffers(texts)
        lower = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(X.LOWER[data]))
        parts = pc.split_pattern_regex(lower, SEPARATORS)
        flat, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
        filled = pc.not_equal(flat, "")
        words = flat.filter(filled).dictionary_encode()
        row = row.filter(filled).to_numpy()
        index = words.indices.to_numpy()
        spelled = words.dictionary.cast(pa.large_binary()).to_pylist()
        crc = np.fromiter(map(zlib.crc32, spelled), np.int64, len(spelled))
        self.words = np.bincount(row, minlength=len(texts))
        found = [(crc % buckets, index, row)]
        gram, at, wide = index, row, len(spelled)
        for n in range(2, longest + 1):
            inside = at[: len(at) - 1] == row[n - 1 :] if len(at) else np.zeros(0, bool)
            first, second = gram[: len(gram) - 1][inside], index[n - 1 :][inside]
            at = at[: len(at) - 1]
            pairs = pa.array(first.astype(np.int64) * max(wide, 1) + second).dictionary_encode()
            distinct = pairs.dictionary.to_numpy()
            crc = np.fromiter(
                (zlib.crc32(b" " + spelled[w], before) for before, w in zip(crc[distinct // max(wide, 1)].tolist(), (distinct % max(wide, 1)).tolist())),
                np.int64,
                len(distinct),
            )
            # a place that begins no n-gram of this length begins no longer one: it keeps an index that is never used
            gram = np.zeros(len(at), np.int64)
            gram[inside] = pairs.indices.to_numpy()
            found.append((crc % buckets, gram[inside], at[inside]))
        self.found = found
        self.n = sum(np.bincount(r, minlength=len(texts)) for _, _, r in found)

    def counts(self, buckets: int) -> np.ndarray:
        return sum(np.bincount(bucket[index], minlength=buckets) for bucket, index, _ in self.found)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """Segment sums of the features' gains by text."""
        out = np.zeros(len(self.words), np.int64)
        for bucket, index, row in self.found:
            if len(index):
                start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                out[row[start]] += np.add.reduceat(np.take(np.take(gains, bucket), index), start)
        return out


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a few megabytes of text; one longer text is a piece."""
    for at, to, _, _ in X.chunks(batch.column("text"), 4 * X.CHUNK_BYTES):
        yield batch.slice(at, to - at)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, features) over all rows of (text); a task sends at most one row a bucket. Null is no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in _pieces(batch):
                total += Features(piece.column("text"), buckets, longest).counts(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "features"])

    own = texts.select("text").mapInArrow(run, "bucket bigint, features bigint")
    return own.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket, in doubles."""

    def dense(texts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for r in bucket_counts(texts, buckets, longest).collect():  # at most ``buckets`` rows
            out[r["bucket"]] = r["features"]
        return out

    s, t = dense(source), dense(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """A Gumbel variate of the document in thousandths, from the first 32 bits of sha256(``seed:doc_id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                f = Features(piece.column("text"), buckets, longest)
                columns = [pa.array(x, pa.int64()) for x in (f.words, f.n, f.sums(gain))]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null for rows that are not drawn.

    Words are lowered in A-Z and hold digits, letters and all characters beyond ASCII; features are all runs of 1 to ``longest`` of
    them. Of the N rows with ``min_words`` words or more, floor(percent * N / 100) are drawn by highest score. Ties go to the
    smaller doc_id, null ids after all others (their noise is that of an empty id), rows of one id by their features; rows equal
    in all that get successive ranks. Null, empty and blank texts have no features, weight 0 and are not drawn. A very long text is
    a chunk's work by itself and is used whole. An empty table gives no rows, an empty ``target`` has zero counts. Other columns are
    ignored.
    """
    scored = weigh(docs, gains(docs, target, buckets, longest), longest)
    scored = saved(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    able = scored.where(F.col("n_words") >= min_words)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "n_features", "n_words"]
    # ids that Spark gives rows of a partition count up from (partition << 33), so a sorted partition numbers itself
    run = able.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    run = saved(run)
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["rows"] for r in run.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()}  # a row a task
    ordered = sorted(sizes)
    before = dict(zip(ordered, np.cumsum([0, *(sizes[p] for p in ordered)]).tolist()))
    drawn = percent * sum(sizes.values()) // 100
    needed = [p for p in ordered if before[p] < drawn]
    first = F.lit(0).cast("long")
    if needed:
        first = F.element_at(F.map_from_arrays(F.array(*map(F.lit, needed)), F.array(*(F.lit(before[p]).cast("long") for p in needed))), part)
    rank = (first + place + 1).cast("long")
    ranked = run.withColumn("rank", F.when(part.isin(needed) & (rank <= drawn), rank))
    few = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank").union(few.select("doc_id", "n_features", "weight", "score", "rank"))
