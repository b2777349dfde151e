"""Language-model scoring by masked pseudo-likelihood.

A small network predicts every word from the two words on each side of it; a document's score is the sum of the
log-probabilities of its words, each hidden in turn. The output is factored: the network gives the word's class, corpus counts
give the word within its class, so the normalisation is over the classes only. Counts come from all documents. The network is
trained in numpy, data-parallel: every partition takes gradient steps on its part of all documents, and the results are
averaged block by block in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X
from medloom.llm.cluster import saved, share_of_hash

WORDS = 1 << 16  # hashed word table: counts and classes
INPUTS = 1 << 12  # hashed input embeddings; one more row stands beyond a document's ends
CLASSES = 48
WIDTH = 16
HIDDEN = 24
SIDE = 2  # words seen on each side
TRAIN_SHARE = 1.0  # of all documents, by hash: all of them
ROUNDS = 2
RATE = 0.2
STEP = 256  # words in a gradient step
BLOCK = 1024  # parameters averaged as one row
PART = 1024  # words scored at once, so that their scores stay in the cache
WIDE = 60.0  # scores within this need no shift: their single-precision exponentials neither overflow nor vanish

_PAIRS = np.arange((INPUTS + 1) * WIDTH // 2).reshape(INPUTS + 1, -1)  # places of an input row, two parameters at each

_SHAPES = {
    "embed": (INPUTS + 1, WIDTH),
    "w1": (2 * SIDE * WIDTH, HIDDEN),
    "b1": (HIDDEN,),
    "w2": (HIDDEN, CLASSES),
    "b2": (CLASSES,),
}
_SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


def initial(seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.0 if name[0] == "b" else 1 / np.sqrt(shape[-1]), shape).ravel() for name, shape in _SHAPES.items()]
    return np.concatenate(parts).astype(np.float32)


def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a chunk and where each row begins."""
    w = X.words(data, offsets)
    return (w.hashes() >> np.uint64(64 - 16)).astype(np.int64), w.first


def _contexts(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Input rows left and right of every word; beyond its document is row INPUTS."""
    n = len(tokens)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inputs = (tokens * 40503 >> 4) % INPUTS
    out = np.full((n, 2 * SIDE), INPUTS, np.int64)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = np.arange(n) + shift
        good = (at >= 0) & (at < n)
        good[good] = row[at[good]] == row[good]
        out[good, k] = inputs[at[good]]
    return out


def _scores(p: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and scores of the classes, with exponentials that neither overflow nor vanish."""
    x = p["embed"].take(context, axis=0).reshape(len(context), -1)
    h = x @ p["w1"]
    h += p["b1"]
    np.tanh(h, out=h)
    z = h @ p["w2"]
    z += p["b2"]
    if z.size and not -WIDE < z.min() <= z.max() < WIDE:
        z -= z.max(axis=1, keepdims=True)
    return x, h, z


def _forward(p: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, h, z = _scores(p, context)
    return x, h, z - np.log(np.exp(z) @ np.ones(CLASSES, z.dtype))[:, None]


def log_likelihood(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of every target class."""
    z = _scores(p, context)[2]
    own = z.ravel()[np.arange(len(target)) * CLASSES + target]
    np.exp(z, out=z)
    return own - np.log(z @ np.ones(CLASSES, z.dtype))


def train_step(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, rate: float) -> None:
    n = len(target)
    x, h, d = _scores(p, context)
    np.exp(d, out=d)
    d /= (d @ np.ones(CLASSES, d.dtype))[:, None]
    d.ravel()[np.arange(0, n * CLASSES, CLASSES) + target] -= 1
    d *= rate / n
    dh = d @ p["w2"].T
    dh *= 1 - h * h
    dx = dh @ p["w1"].T
    ones = np.ones(n, d.dtype)
    p["w2"] -= h.T @ d
    p["b2"] -= ones @ d
    p["w1"] -= x.T @ dh
    p["b1"] -= ones @ dh
    # several words of a step may have the same neighbour: at() takes every one off, and is fast on flat places alone;
    # complex numbers take two parameters at a place
    places = _PAIRS.take(context.ravel(), axis=0).ravel()
    dx *= 8
    np.subtract.at(p["embed"].reshape(-1).view(np.complex64), places, dx.ravel().view(np.complex64))


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of every hashed word over all documents; each partition sends its own table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WORDS, np.int64)
        for batch in batches:
            for _, _, data, offsets in X.chunks(batch.column("text")):
                total += np.bincount(_tokens(data, offsets)[0], minlength=WORDS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["word", "n"])

    sums = docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(WORDS, np.int64)  # at most WORDS rows came
    out[sums["word"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every word, so that classes hold about equal mass of like frequency, and log P(word | class)."""
    weight = counts + 0.5
    order = np.lexsort((np.arange(WORDS), -counts))
    before = np.cumsum(weight[order]) - weight[order]
    of = np.zeros(WORDS, np.int64)
    of[order] = np.minimum((before / weight.sum() * CLASSES).astype(np.int64), CLASSES - 1)
    return of, np.log(weight) - np.log(np.bincount(of, weight, CLASSES)[of])


def train(docs: DataFrame, of: np.ndarray, share: float = TRAIN_SHARE, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after ``rounds`` of local steps and averaging, weighted by words seen."""
    chosen = docs.select("doc_id", "text")
    if share < 1:
        chosen = saved(chosen.where(share_of_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), share)))
    context = docs.sparkSession.sparkContext
    flat = initial()
    for r in range(rounds):
        sent = context.broadcast((flat, of))
        rate = RATE * (1 - r / rounds)

        def run(batches: Iterator[pa.RecordBatch], rate: float = rate, sent=sent) -> Iterator[pa.RecordBatch]:
            own, seen = sent.value[0].copy(), 0
            p = _views(own)
            for batch in batches:
                for _, _, data, offsets in X.chunks(batch.column("text")):
                    tokens, first = _tokens(data, offsets)
                    around, target = _contexts(tokens, first), sent.value[1][tokens]
                    order = np.random.default_rng(len(tokens)).permutation(len(tokens))
                    around, target = around.take(order, axis=0), target.take(order)
                    for at in range(0, len(order), STEP):
                        train_step(p, around[at : at + STEP], target[at : at + STEP], rate)
                    seen += len(tokens)
            if seen:
                pieces = [own[at : at + BLOCK].astype(np.float64) for at in range(0, _SIZE, BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(len(pieces)), pa.int64()),
                        pa.array([float(seen)] * len(pieces)),
                        pa.array(pieces, pa.list_(pa.float64())),
                    ],
                    ["block", "weight", "params"],
                )

        def average(group: pd.DataFrame) -> pd.DataFrame:
            mean = np.average(np.stack(group["params"].to_numpy()), axis=0, weights=group["weight"].to_numpy())
            return pd.DataFrame({"block": [group["block"].iloc[0]], "params": [mean]})

        local = chosen.mapInArrow(run, "block bigint, weight double, params array<double>")
        mean = local.groupBy("block").applyInPandas(average, "block bigint, params array<double>").toPandas()
        if len(mean):
            flat = np.concatenate(mean.sort_values("block")["params"].tolist()).astype(np.float32)
    return flat


def score(docs: DataFrame, share: float = TRAIN_SHARE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, pseudo_loglik, mean_loglik) for every row.

    ``pseudo_loglik`` sums log P(word | two words on each side) over the whole text. Null and empty texts have 0 words, sum 0 and
    a null mean. Words are compared by hash (WORDS buckets). An empty table gives no rows; other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    of, within = classes(word_counts(plain))
    sent = docs.sparkSession.sparkContext.broadcast((train(plain, of, share, rounds), of, within))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, of, within = sent.value
        p = _views(flat)
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("text"), 1 << 18):
                tokens, first = _tokens(data, offsets)
                logs = np.zeros(len(tokens) + 1)
                for a in range(0, len(tokens), 8192):
                    # the window of the slice, with what stands beside it
                    left, right = max(0, a - SIDE), min(len(tokens), a + 8192 + SIDE)
                    bounds = np.clip(first, left, right) - left
                    around = _contexts(tokens[left:right], bounds)[a - left : a - left + 8192]
                    own = tokens[a : a + 8192]
                    for b in range(0, len(own), PART):
                        part = slice(b, b + PART)
                        logs[a + b + 1 : a + b + 1 + len(own[part])] = log_likelihood(p, around[part], of[own[part]])
                    logs[a + 1 : a + 1 + len(own)] += within[own]
                sums = np.cumsum(logs)
                n = np.diff(first)
                total = sums[first[1:]] - sums[first[:-1]]
                mean = pa.array(np.divide(total, n, out=np.zeros_like(total), where=n > 0), mask=n == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), pa.array(n, pa.int64()), pa.array(total), mean],
                    ["doc_id", "n_words", "pseudo_loglik", "mean_loglik"],
                )

    return plain.mapInArrow(run, "doc_id bigint, n_words bigint, pseudo_loglik double, mean_loglik double")
