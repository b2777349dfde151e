"""Operators 11 to 13 against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import pyspark.sql.functions as F

from medloom.llm import align, jaccard, minhash, queries, resample

DATA = "/root/testdata/sf0.001"
A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
ROWS = [
    (1, A),
    (1, A),
    (2, A.upper() + " é9_x"),
    (3, None),
    (4, ""),
    (5, "  \t\n -- "),
    (6, "a b"),
    (None, A + " extra"),
    (None, None),
    (8, (A + "\n") * 40 + "Überall ≠ straße " * 30),
    (9, "x" * 50_000 + " " + "w " * 3000),
    (9, A.replace("ten", "zehn")),
    (-4, A),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns carry the operators' own names."""
    extra = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text")
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string").union(extra)
    clash = "size score rank weight n_words n_features rid at part pairs links docs best pair n rep key f1 f2 root component_id kept".split()
    return frame.withColumns({c: F.lit("clash") for c in clash})


def _resampled(rows, target, percent, min_words, buckets, longest):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")

    def features(text):
        w = word.findall(low(text))
        return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(d, *features(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(map(bucket, f))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = []
    for d, n, f in found:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(x)) for x in f)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = percent * len(able) // 100
    ranked = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted([*ranked, *((*r[:4], None) for r in out if r[4] < min_words)], key=repr)


@pytest.mark.parametrize("percent,min_words,buckets,longest", [(10, 20, 10_000, 1), (100, 1, 97, 3), (50, 0, 5, 2), (0, 20, 10_000, 1)])
def test_resample(spark, docs, percent, min_words, buckets, longest):
    target = spark.read.parquet(f"{DATA}/benchmark.parquet").withColumn("weight", F.lit(1))
    got = sorted((tuple(r) for r in resample.resample(docs, target, percent, min_words, buckets, longest).collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got == _resampled(rows, [r["text"] for r in target.collect()], percent, min_words, buckets, longest)


def test_resample_empty(spark, docs):
    target = spark.createDataFrame([(None,), ("",)], "text string")
    assert resample.resample(docs.limit(0), target).count() == 0
    got = resample.resample(docs.where("doc_id < 10"), target.limit(0)).collect()
    assert len(got) == 11 and all(r["weight"] >= 0 or r["n_features"] for r in got)


def test_resample_equals_sql(spark):
    from checks.compare import check

    ok, note = check(spark, DATA, queries.Q["op11_importance_resampling"], queries.SQL["op11_importance_resampling"])
    assert ok, note


def _aligned(texts, path_a, path_b):
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(path_a)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=path_b)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    out, docs_of = [], Counter()
    for text in texts:
        groups, links = [], Counter()
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        x = [bytes(byte_of[c] for c in left.id_to_token(i)) for i in a]
        y = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(x) == b"".join(y) == (" " + text).encode():
            a, b, x, y = [], [], [], []
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in (x, y)]
        at = [0, 0]
        for e in sorted(set(ends[0]) & set(ends[1])):
            to = [ends[0].index(e) + 1, ends[1].index(e) + 1]
            groups.append((a[at[0] : to[0]], b[at[1] : to[1]]))
            at = to
        for p, q in groups:
            links.update((i, j) for i in p for j in q)
        docs_of.update(links.keys())
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((len(a), len(b), len(groups), links, hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (i, _), n in docs_of.items():
        most[i] = max(most[i], n)
    for n_a, n_b, n_groups, links, digest in out:
        best = sum(n for p, n in links.items() if docs_of[p] == most[p[0]])
        yield n_a, n_b, n_groups, sum(links.values()), best, sum(n * docs_of[p] for p, n in links.items()), digest


@pytest.mark.parametrize("most_pairs", [align.MOST_PAIRS, 500, 0])
def test_align(spark, docs, most_pairs):
    hard = ["<|endoftext|> <s>a</s>", "space▁mark", "\x00\x01 é İ ١٢ 漢字かな 😂‍👍", "  two  spaces \n\n\n", "don't WE'LL ''s", "=" * 999]
    frame = docs.select("doc_id", "text", "pairs", "docs").where("doc_id < 1060 or doc_id is null")
    frame = frame.union(spark.createDataFrame([(k, t, "", "") for k, t in enumerate(hard, 5000)], frame.schema))
    a, b = queries.public_file("byte_bpe_50k.json"), queries.public_file("piece_bpe_32k.model")
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    want = sorted(((d, *w) for (d, _), w in zip(rows, _aligned([t for _, t in rows], a, b))), key=repr)
    got = sorted((tuple(r) for r in align.measure(frame, a, b, most_pairs).collect()), key=repr)
    assert got == want
    assert align.measure(frame.limit(0), a, b).count() == 0
    assert align.measure(frame.where("text is null"), a, b).count() == 2


def test_products_equal_dense(monkeypatch):
    rng = np.random.default_rng(3)
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(align, "EXPANSION", block)
        for _ in range(30):
            n, m, k = rng.integers(1, 12, 3)
            x, y = rng.integers(0, 3, (n, m)), rng.integers(0, 3, (m, k))
            sparse = [align.Csr.build(np.repeat(np.nonzero(z)[0], z[z > 0]), np.repeat(np.nonzero(z)[1], z[z > 0]), *z.shape) for z in (x, y)]
            out = np.zeros((n, k), np.int64)
            for at, to in sparse[0].blocks(sparse[1]):
                row, column, value = sparse[0].times(sparse[1], at, to)
                out[row, column] += value
            assert (out == x @ y).all()


def test_overlaps_are_shared_bytes():
    a, b, n = align.overlaps(np.array([3, 4, 9]), np.array([2, 4, 5, 9]))
    assert list(zip(a.tolist(), b.tolist(), n.tolist())) == [(0, 0, 2), (0, 1, 1), (1, 1, 1), (2, 2, 1), (2, 3, 4)]
    of_a, of_b = align.groups(a, b, 3, 4)
    assert of_a.tolist() == [0, 0, 1] and of_b.tolist() == [0, 0, 1, 1]


def _components(rows, size, percent):
    """{doc_id: (component)} and the set size of each row, by comparing all pairs."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for _, text in rows:
        w = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (d, x), (e, y) in combinations([(d, s) for (d, _), s in zip(rows, sets) if d is not None and s], 2):
        if d != e and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(d), find(e)))
            root[b] = a
    return [(d, len(s), None if d is None else find(d), d is None or find(d) == d) for (d, _), s in zip(rows, sets)]


@pytest.mark.parametrize("size,percent", [(5, 85), (3, 80)])
def test_minhash(spark, docs, size, percent):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    base = [word() for _ in range(120)]
    more = []
    for k in range(120):  # copies of one text with one to ten changed words; many are linked with others only through it
        x = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            x[at] = word()
        more.append((7000 + k, " ".join(x)))
    # one id, two texts: each links the document with another one
    other = " ".join(word() for _ in range(60))
    more += [(8000, other), (8001, other + " end"), (8001, " ".join(base) + " end"), (8002, other)]
    frame = docs.select("doc_id", "text", "kept", "n").union(spark.createDataFrame([(d, t, "", "") for d, t in more], "doc_id bigint, text string, kept string, n string"))
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    want = _components(rows, size, percent)
    got = minhash.near_duplicates(frame, size, percent).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_tensored_tables_miss_few():
    """Pairs at the threshold share a key: hardly one in ten thousand is missed, also with few shingles."""
    rng = np.random.default_rng(4)
    missed = 0
    for n in (40, 400):
        same = round(n * 2 * 0.85 / 1.85)
        for _ in range(300):
            tokens = rng.integers(0, 1 << 63, 2 * n - same, dtype=np.uint64)
            x, y = tokens[:n], tokens[n - same :]
            least = [[(z * f).min() for f in minhash._FACTORS] for z in (x, y)]
            equal = (np.array(least[0]) == np.array(least[1])).reshape(2, minhash.BLOCKS, minhash.BAND).all(axis=2).any(axis=1)
            missed += not equal.all()
    assert missed <= 1


def test_jaccard_ids_with_several_texts(spark):
    """A copy's id that has a second text keeps that text's links."""
    rng = np.random.default_rng(6)
    text = lambda: [f"w{k}" for k in rng.integers(0, 1 << 30, 80)]
    a, b, c = text(), text(), text()
    rows = [(1, a), (2, a), (2, b), (3, [*b, "end"]), (4, c), (5, c), (5, [*c, "end"]), (6, [*b, "end"]), (7, text())]
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id bigint, text string")
    for join in (jaccard.join, minhash.near_duplicates):
        got = {(r["doc_id"], r["component_id"]) for r in join(frame).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (6, 1), (4, 4), (5, 4), (7, 7)}, join
