"""Quality classifier on supervised subword embeddings.

A text is the mean of learned vectors of its words, of its character 3- and 4-grams and of its repeated words, all hashed into
one table; a softmax over that mean gives the class. Training is plain stochastic gradient descent in numpy on a bounded sample
of labelled rows. As the mean is linear, a trained table is folded to one number per feature before it is sent to score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X
from medloom.llm.cluster import free_name, saved

MOST_LABELLED = 6_000  # labelled rows that are fitted, chosen by hash of the id
BITS = 17
BUCKETS = 1 << BITS  # one more row is the repeat feature: a word equal to the one before it
WIDTH = 8
EPOCHS = 4
RATE = 0.5
THRESHOLD = 0.3
_MUL = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature ids, row bounds) of character 3- and 4-grams; a gram may begin or end at a word's edge but not span two words."""
    rows = len(offsets) - 1
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:  # not UTF-8: its bytes are the characters
        points, lead = data.astype(np.uint32), offsets
    # a blank before every row and after the last keeps rows apart
    at = lead + np.arange(rows + 1)
    spaced = np.full(len(points) + rows + 1, 32, np.uint32)
    spaced[np.arange(len(points)) + np.repeat(np.arange(1, rows + 1), np.diff(lead))] = points
    blank = (spaced == 32) | ((spaced >= 9) & (spaced <= 13))
    spaced[blank] = 32
    for size in (3, 4):
        n = len(spaced) - size + 1
        if n <= 0:
            continue
        inner = ~blank[1 : n + 1]
        for k in range(2, size - 1):
            inner = inner & ~blank[k : n + k]
        place = np.flatnonzero(inner)
        h = np.full(len(place), size, np.uint32)
        for k in range(size):
            h = (h ^ spaced[place + k]) * _MUL[k]
            h ^= h >> np.uint32(15)
        yield h >> np.uint32(32 - BITS), np.searchsorted(place, at)


def _features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: ids of the chunk in row order, and where each row begins."""
    w = X.words(data, offsets)
    h = w.hashes()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (w.row_of_word()[1:] == w.row_of_word()[:-1])
    again = np.flatnonzero(same)
    return [
        *_grams(data, offsets),
        ((h >> np.uint64(64 - BITS)).astype(np.uint32), w.first),
        (np.full(len(again), BUCKETS, np.uint32), np.searchsorted(again, w.first)),
    ]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 11) -> np.ndarray:
    """Folded weights: one number per feature, and the bias last. ``rows``: (feature ids, shares, class 0 or 1)."""
    rng = np.random.default_rng(seed)
    classes = {y for _, _, y in rows}
    if len(classes) < 2:  # nothing to learn: a constant answer
        out = np.zeros(BUCKETS + 2)
        out[-1] = 0.0 if not classes else (6.0 if 1 in classes else -6.0)
        return out
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS + 1, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            ids, share, y = rows[r]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = share @ table[ids] if len(ids) else np.zeros(WIDTH, np.float32)
            z = mean @ out + bias
            z = np.exp(z - z.max())
            error = z / z.sum()
            error[y] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            if len(ids):
                table[ids] -= (rate * len(ids) ** 0.5) * share[:, None] * back
    return np.append(table.astype(np.float64) @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> np.ndarray:
    """Folded weights from at most about ``most`` labelled rows that are not held out.

    Labels: the lowest of an id counts; null ids and labels are left out, as are documents without a label or with null text.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    count = known.count()
    part = F.pmod(F.xxhash64(F.lit("subword"), "doc_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, most / max(1, count)) * (1 << 30)))
    rows = docs.select("doc_id", "text").join(F.broadcast(known.where(part)), "doc_id").where("text is not null")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            quality = batch.column("quality").to_numpy()
            for at, to, data, offsets in X.chunks(batch.column("text")):
                kinds = _features(data, offsets)
                for r in range(to - at):
                    ids = np.concatenate([f[b[r] : b[r + 1]] for f, b in kinds])
                    ids, times = np.unique(ids, return_counts=True)
                    found.append((ids, (times / max(1, times.sum())).astype(np.float32), int(quality[at + r] != 0)))
        yield pa.RecordBatch.from_arrays([pa.array([train(found)], pa.list_(pa.float64()))], ["weights"])

    # the sample is bounded, so one task may hold it; the order makes reruns agree
    one = saved(rows).repartition(1).sortWithinPartitions("doc_id", F.xxhash64("text"))
    row = one.mapInArrow(learn, "weights array<double>").first()
    return np.array(row["weights"]) if row else train([])  # without labelled rows there is no task


def score(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns and column ``name`` (0 to 1, higher: better) of every row; null and empty texts score by the bias alone.

    A kept column of that name is replaced; others pass through, whatever their names. Repeated rows score alike, a very long
    text is read whole, and an empty table gives no rows.
    """
    fields = [f for f in docs.schema.fields if f.name in keep and f.name.lower() != name.lower()]
    names = [f.name for f in fields]
    own = free_name(docs, "_text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{name}` double"])
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column(own)):
                total, count = np.zeros(to - at), np.zeros(to - at)
                for ids, first in _features(data, offsets):
                    run_sum = np.concatenate(([0.0], np.cumsum(w[ids])))
                    total += run_sum[first[1:]] - run_sum[first[:-1]]
                    count += np.diff(first)
                z = np.divide(total, count, out=np.zeros_like(total), where=count > 0) + w[-1]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n).slice(at, to - at) for n in names), pa.array(1 / (1 + np.exp(-z)))], [*names, name]
                )

    return docs.select(*(docs[n] for n in names), docs["text"].alias(own)).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
