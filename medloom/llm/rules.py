"""Quality rules: text statistics and a learned decision list, emitted as ordered conditional expressions.

Sequential covering: grow a conjunction of thresholds on part of the labelled statistics until it holds low-quality documents
only, prune it on the other part, keep it if it is precise there, drop the documents it covers, and go on. What no rule
covers is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Bound on the labelled rows that are fitted, chosen by hash of the id.
MOST_LABELLED = 20_000
MOST_CONDITIONS = 3
MOST_RULES = 12
LEAST_PRECISION = 0.9
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")
# Statistics that conditions are made of: shares, so that a rule reads alike for short and long texts.
FEATURES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "mean_word": ("word_chars", "n_words"),
    "n_words": ("n_words", None),
}

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)


def _chunk_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    w = X.words(data, offsets)
    rows = len(offsets) - 1
    out = {"n_words": w.count}
    out["word_chars"] = w.per_row(~w.space & ((data & 0xC0) != 0x80))
    out["n_symbols"] = w.per_row(_SYMBOL[data])
    out["n_upper"] = w.per_row(_UPPER[data])
    # lines with a word; a line ends at \n or with its row
    inner = offsets[:-1][offsets[:-1] < len(data)]
    starts = np.unique(np.concatenate([inner, np.flatnonzero(data == 10) + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))[: len(starts)]
    ends = ends - (data[np.maximum(ends - 1, 0)] == 10)
    filled = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[filled], ends[filled]
    row = np.searchsorted(offsets, starts, side="right") - 1
    key = X.mix(w.span_hash(starts, ends) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out["n_lines"] = np.bincount(row, minlength=rows)
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    out["n_dup_lines"] = np.bincount(row[again], minlength=rows)
    # words inside a window that its row holds twice
    grams = X.windows(w.hashes(), WINDOW)
    inside = np.flatnonzero(X.within_rows(w.first, WINDOW, len(grams)))
    key = X.mix(grams[inside] + w.row_of_word()[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    begin = np.zeros(len(w.starts) + WINDOW + 1, np.int64)
    np.add.at(begin, inside[twice], 1)
    np.add.at(begin, inside[twice] + WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(begin)[: len(w.starts)] > 0)))
    out["n_repeat_words"] = covered[w.first[1:]] - covered[w.first[:-1]]
    return out


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the counts of every row. Null text counts as empty: all counts are 0."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    names = [f.name for f in fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{c} bigint" for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("_text")):
                counts = _chunk_counts(data, offsets)
                arrays = [batch.column(n).slice(at, to - at) for n in names]
                arrays += [pa.array(counts[c], pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(arrays, [*names, *COUNTS])

    return docs.select(*names, F.col("text").alias("_text")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        over, under = FEATURES[self.feature]
        value = F.col(over).cast("double")
        if under:
            value = F.when(F.col(under) > 0, value / F.col(under)).otherwise(F.lit(0.0))
        return value >= self.threshold if self.above else value <= self.threshold

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(x) for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>=' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


def _candidates(values: np.ndarray, low: np.ndarray) -> list[float]:
    """Thresholds half-way between neighbouring quantiles of the values, of the low-quality ones above all."""
    points = np.unique(np.concatenate([np.quantile(low, np.linspace(0, 1, 33)), np.quantile(values, np.linspace(0, 1, 33))]))
    return list((points[1:] + points[:-1]) / 2)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained by narrowing (p0 low, n0 good) to (p, n)."""
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else -1.0


def _grow(x: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    here = np.ones(len(low), bool)
    while len(rule) < MOST_CONDITIONS and here[~low].any():
        p0, n0 = int((here & low).sum()), int((here & ~low).sum())
        best, best_gain = None, 1e-9
        for feature in FEATURES:
            values = x[feature]
            if not (here & low).any():
                break
            for t in _candidates(values[here], values[here & low]):
                for above in (True, False):
                    c = Condition(feature, above, float(t))
                    hit = here & c.holds(x)
                    gain = _gain(int((hit & low).sum()), int((hit & ~low).sum()), p0, n0)
                    if gain > best_gain:
                        best, best_gain = c, gain
        if best is None:
            break
        rule.append(best)
        here &= best.holds(x)
    return rule


def _precision(rule: list[Condition], x: dict[str, np.ndarray], low: np.ndarray) -> tuple[float, int]:
    hit = Rule(tuple(rule)).holds(x)
    return ((hit & low).sum() + 1) / (hit.sum() + 2), int((hit & low).sum())


def _prune(rule: list[Condition], x: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    """Drop last conditions while (low - good) / (low + good) on the pruning part does not get worse."""

    def worth(r):
        hit = Rule(tuple(r)).holds(x)
        p, n = (hit & low).sum(), (hit & ~low).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(x: dict[str, np.ndarray], low: np.ndarray) -> list[Rule]:
    """Ordered rules for low quality. ``low`` marks the low-quality rows; without any, or without others, there are no rules."""
    rules: list[Rule] = []
    left = np.ones(len(low), bool)
    grows = np.arange(len(low)) % 3 != 2
    while len(rules) < MOST_RULES and (left & low & grows).any() and (left & ~low).any():
        part = lambda which: ({k: v[which] for k, v in x.items()}, low[which])
        rule = _grow(*part(left & grows))
        if not rule:
            break
        rule = _prune(rule, *part(left & ~grows))
        good, covered = _precision(rule, *part(left & ~grows))
        if good < LEAST_PRECISION and not (covered == 0 and _precision(rule, *part(left))[0] >= LEAST_PRECISION):
            break
        rules.append(Rule(tuple(rule)))
        left &= ~rules[-1].holds(x)
    return rules


def features(rows) -> dict[str, np.ndarray]:
    out = {}
    for name, (over, under) in FEATURES.items():
        a = np.asarray(rows[over], float)
        b = np.asarray(rows[under], float) if under else np.ones_like(a)
        out[name] = np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    return out


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[Rule]:
    """Rules from at most about ``most`` labelled documents, chosen by hash; only these documents are read for it.

    Labels: one per document, the lowest where several disagree; null ids, null labels and unlabelled documents take no part.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    count = known.count()
    part = F.pmod(F.xxhash64(F.lit("rules"), "doc_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, most / max(1, count)) * (1 << 30)))
    chosen = known.where(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by ``most``
    stats = statistics(rows, ("doc_id", "quality")).where(~base_failed())  # what the base rejects needs no rule
    stats = stats.orderBy("doc_id", *COUNTS).toPandas()
    return learn(features(stats), stats["quality"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """False from the first rule that holds, else true."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(), F.lit(False)).otherwise(out)
    return out


def apply(docs: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Statistics of every row with ``base_failed``, ``rule`` (number of the first rule that holds, from 1) and ``kept``."""
    which = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        which = F.when(rule.column(), F.lit(k)).otherwise(which)
    stats = statistics(docs, keep)
    return stats.withColumns({"base_failed": base_failed(), "rule": which, "kept": ~base_failed() & verdict(rules)})
