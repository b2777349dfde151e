"""Operators that pass columns through hold whatever names these have: those of their outputs and of their own columns."""

import numpy as np
import pytest

from medloom.llm import bpe, lines, mixing, queries, subword

NAMES = "row size source_size target copies taken weight whole cut hash _hash copy rid gone score _text n_tokens ids h root keep".split()


@pytest.fixture(scope="module")
def clashing(spark):
    texts = ["some words of a text", None, "", "x " * 40_000, "some words of a text", "other words\nsome words of a text"]
    rows = [(k // 2, t, None if k == 3 else "s", *(f"{n}{k}" for n in NAMES)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in NAMES))


def _other(df, *names):
    return sorted(df.select(*[n for n in NAMES if n not in names]).collect(), key=repr)


def test_mixing(clashing):
    out = mixing.sample(clashing)
    assert out.columns == clashing.columns and set(_other(out)) <= set(_other(clashing))
    assert mixing.sample(clashing.limit(0)).count() == 0


def test_lines(clashing):
    out = lines.dedup(clashing)
    assert _other(out) == _other(clashing)


def test_subword(clashing):
    weights = np.zeros(subword.BUCKETS + 2)
    out = subword.score(clashing, weights, tuple(clashing.columns))
    assert _other(out, "score") == _other(clashing, "score") and {r["score"] for r in out.collect()} == {0.5}
    named = subword.score(clashing, weights, tuple(clashing.columns), "verdict")
    assert named.columns == [*clashing.columns, "verdict"] and _other(named) == _other(clashing)
    assert subword.score(clashing.limit(0), weights, ("doc_id",)).count() == 0


def test_bpe(clashing):
    path = queries.vocabulary_path()
    keep = tuple(c for c in clashing.columns if c != "text")
    for out in (bpe.round_trip(clashing, path, keep), bpe.decode(bpe.encode(clashing, path, keep), path)):
        assert len(out.columns) == len(set(out.columns)) == len(clashing.columns)
        assert _other(out, "n_tokens", "ids") == _other(clashing, "n_tokens", "ids")
        assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in out.collect())
    assert bpe.encode(clashing.limit(0), path).count() == 0


def test_pipeline_stages(spark, clashing):
    import corpus_pipeline as P

    for name, stage in P.STAGES:
        out = stage(spark, clashing, "/root/testdata/sf0.001")
        assert set(clashing.columns) <= set(out.columns), name
        out.collect()
