"""Cross-tokenizer alignment by products of sparse matrices.

Both tokenizers cut the same bytes. A token-byte incidence matrix has a row per token with ones at its bytes. Row products of A
with the transpose of B (Gustavson's scheme, on hand-built CSR arrays) give each overlapping pair of tokens with its shared bytes.
Where successive overlaps change both tokens, both sides end: these byte offsets cut the tokens into groups. Products of the
id-group incidence of A with the group-id incidence of B give every linked pair of ids of a document with its number of links.

How many documents hold a pair is counted by Spark. Documents then meet these counts in two parts: the most frequent pairs (at most
MOST_PAIRS, whatever the corpus) are an array on every worker, all rarer ones are joined. Both parts hold at every size.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X
from medloom.llm.bpe import SETTLED, byte_alphabet
from medloom.llm.cluster import saved

MOST_PAIRS = 1_000_000  # pairs whose counts every worker holds
MOST_PIECES = 300_000  # pre-split pieces whose ids a worker remembers, and as many of those before
EXPANSION = 1 << 22  # elements of a product that are held at a time
# the public pre-split of the byte-level file's kind
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass
class Csr:
    """Rows of a sparse matrix: columns ``indices[indptr[i]:indptr[i + 1]]`` with ``values``."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    @classmethod
    def build(cls, row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Csr:
        """From (row, column) ones; those of one place are summed."""
        key = row.astype(np.int64) * columns + column
        if len(key) and (key[1:] < key[:-1]).any():
            key = np.sort(key)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        values = np.diff(np.append(first, len(key)))
        row, column = np.divmod(key[first], max(columns, 1))
        return cls(np.searchsorted(row, np.arange(rows + 1)), column, values, columns)

    def blocks(self, other: Csr) -> Iterator[tuple[int, int]]:
        """Row ranges whose products with ``other`` have about EXPANSION elements; a single row may have more."""
        size = np.diff(other.indptr)[self.indices]
        upto = np.concatenate(([0], np.cumsum(size)))[self.indptr]
        at = 0
        while at < self.rows:
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + EXPANSION, side="right")) - 1)
            yield at, to
            at = to

    def times(self, other: Csr, at: int = 0, to: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, value) of the product's rows ``at`` to ``to``: each of a row's elements takes the other's row, equal columns add up."""
        to = self.rows if to is None else to
        lo, hi = self.indptr[at], self.indptr[to]
        inner, value = self.indices[lo:hi], self.values[lo:hi]
        row = np.repeat(np.arange(at, to), np.diff(self.indptr[at : to + 1]))
        place, size = other.indptr[inner], other.indptr[inner + 1] - other.indptr[inner]
        total = int(size.sum())
        if (size != 1).any():
            place = np.arange(total) + np.repeat(place - (np.cumsum(size) - size), size)
            row, value = np.repeat(row, size), np.repeat(value, size)
        key = row * other.columns + other.indices[place]
        value = value * other.values[place]
        if total and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if total else np.zeros(0, np.int64)
        row, column = np.divmod(key[first], max(other.columns, 1))
        return row, column, np.add.reduceat(value, first) if total else value


def token_bytes(ends: np.ndarray) -> Csr:
    """Incidence of successive tokens, given where each ends, with the bytes they cover."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)), np.arange(n), np.ones(n, np.int64), n)


def byte_tokens(ends: np.ndarray) -> Csr:
    """The transpose of ``token_bytes``."""
    n = int(ends[-1]) if len(ends) else 0
    token = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
    return Csr(np.arange(n + 1), token, np.ones(n, np.int64), len(ends))


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, bytes) of all overlapping tokens; no token may be empty, and both sides must cover the same bytes."""
    left, right = token_bytes(ends_a), byte_tokens(ends_b)
    parts = [left.times(right, at, to) for at, to in left.blocks(right)]
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3


def groups(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A and B token: a new one begins where successive overlaps change both tokens."""
    new = np.append(True, (a[1:] != a[:-1]) & (b[1:] != b[:-1]))[: len(a)]
    number = np.cumsum(new) - 1
    of_a, of_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    of_a[a], of_b[b] = number, number
    return of_a, of_b


class _Pieces(dict):
    """Ids (32-bit bytes) of pre-split pieces; when full, those met since the last time stay."""

    def __init__(self, library):
        super().__init__()
        self.model, self.old, self.alphabet = library.model, {}, byte_alphabet()

    def learn(self, cut: list[str]) -> None:
        """Afterwards all of ``cut`` is held."""
        new = [p for p in dict.fromkeys(cut) if p not in self]
        if len(self) + len(new) > MOST_PIECES:
            self.old = dict(self)
            self.clear()
            new = list(dict.fromkeys(cut))
        for p in new:
            ids = self.old.get(p)
            if ids is None:
                tokens = self.model.tokenize("".join([self.alphabet[b] for b in p.encode()]))
                ids = np.array([t.id for t in tokens], np.int32).tobytes()
            self[p] = ids


class ByteLevel:
    """Ids of a byte-level BPE file. Texts of settled scripts are pre-split here and pieces remembered; others go to the library whole."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.bytes = [b""] * (max(spec["model"]["vocab"].values(), default=-1) + 1)
        for token, i in spec["model"]["vocab"].items():
            self.bytes[i] = bytes(map(byte_of.__getitem__, token)) if byte_of.keys() >= set(token) else token.encode()
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not spec.get("normalizer")
        self.split = regex.compile(SPLIT) if plain else None
        self.pieces = _Pieces(self.library)

    def encode(self, text: str) -> np.ndarray:
        if self.split is None or SETTLED.fullmatch(text) is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
        cut = self.split.findall(text)
        try:
            ids = list(map(self.pieces.__getitem__, cut))
        except KeyError:
            self.pieces.learn(cut)
            ids = list(map(self.pieces.__getitem__, cut))
        return np.frombuffer(b"".join(ids), np.int32)


class Pieces:
    """Ids of a sentencepiece file, which itself puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, num_threads=1), np.int32)


_loaded: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def _tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """One pair per Python worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = ByteLevel(path_a), Pieces(path_b)
    return _loaded[path_a, path_b]


@dataclass
class Alignment:
    """Successive texts aligned at once. ``a`` and ``b`` are the tokens of both sides, ``first_*`` where each text's begin, ``group_*``
    the group of each token; no group spans two texts, as both sides end with the text."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    @property
    def n_groups(self) -> np.ndarray:
        """Groups of each text."""
        upto = np.append(0, self.group_a + 1)
        return np.diff(upto[self.first_a])

    def spelled(self) -> list[bytes]:
        """The groups of each text in order: decimal ids, those of A before those of B."""
        count = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        many_a, many_b = (np.bincount(g, minlength=count) for g in (self.group_a, self.group_b))
        before = lambda x: np.concatenate(([0], np.cumsum(x)[:-1])) if count else x
        ids, after = (np.zeros(len(self.a) + len(self.b), t) for t in (np.int64, np.uint8))
        at_a = np.arange(len(self.a)) + before(many_b)[self.group_a]
        at_b = np.arange(len(self.b)) + np.cumsum(many_a)[self.group_b]
        ids[at_a], ids[at_b] = self.a, self.b
        after[:] = ord(",")
        after[at_a[np.append(self.group_a[1:] != self.group_a[:-1], True)[: len(at_a)]]] = ord("|")
        after[at_b[np.append(self.group_b[1:] != self.group_b[:-1], True)[: len(at_b)]]] = ord(";")
        digits = np.ones(len(ids), np.int64)
        ten, most = 10, int(ids.max(initial=0))
        while ten <= most:
            digits += ids >= ten
            ten *= 10
        ends = np.cumsum(digits + 1)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = after
        rest = ids
        for k in range(int(digits.max(initial=0))):
            there = slice(None) if k == 0 else digits > k
            rest, last = np.divmod(rest, 10)
            out[ends[there] - 2 - k] = last[there] + ord("0")
        ends = np.append(0, ends)[self.first_a + self.first_b]
        raw = out.tobytes()
        return [raw[x : y - 1] if y > x else b"" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def pairs(self, wide: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, a * wide + b, links) in parts, ascending by text; no pair of a text is in two parts. ``wide`` exceeds all ids of B."""
        text_a, text_b = (np.repeat(np.arange(len(f) - 1), np.diff(f)) for f in (self.first_a, self.first_b))
        count = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        most = int(self.a.max(initial=0)) + 1
        ids_a, at_a = np.unique(text_a * most + self.a, return_inverse=True)
        ids_b, at_b = np.unique(text_b * wide + self.b, return_inverse=True)
        left = Csr.build(at_a, self.group_a, len(ids_a), count)
        right = Csr.build(self.group_b, at_b, count, len(ids_b))
        for at, to in left.blocks(right):
            row, column, links = left.times(right, at, to)
            text, a = np.divmod(ids_a[row], most)
            yield text, a * wide + ids_b[column] % wide, links


def align(a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray) -> Alignment:
    """Align the token sequences of texts that both sides spell alike; ``size_*`` are the byte lengths of the tokens."""
    first = [np.concatenate(([0], np.cumsum([len(x) for x in side], dtype=np.int64))) for side in (a, b)]
    a, b = (np.concatenate([np.zeros(0, np.int32), *side]).astype(np.int64) for side in (a, b))
    x, y, _ = overlaps(np.cumsum(size_a[a]), np.cumsum(size_b[b]))
    return Alignment(a, b, *first, *groups(x, y, len(a), len(b)))


def encode_both(texts: list[str | None], path_a: str, path_b: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Tokens of each text by both sides; none for null and empty texts and where the tokens do not spell the text."""
    left, right = _tokenizers(path_a, path_b)
    none = np.zeros(0, np.int32)
    out: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for text in texts:
        a = b = none
        if text:
            a, b = left.encode(" " + text), right.encode(text)
            spelled = (" " + text).encode()
            for side, ids in ((left, a), (right, b)):
                if b"".join(map(side.bytes.__getitem__, ids.tolist())) != spelled:
                    a = b = none
                    break
        out[0].append(a)
        out[1].append(b)
    return out


ALIGNED = "rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, links array<int>"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every row's token counts, groups and linked id pairs; a row of very many pairs goes on in further pieces."""

    names = [f.strip().split()[0] for f in ALIGNED.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = _tokenizers(path_a, path_b)
        sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (left, right)]
        for batch in batches:
            for at, to, _, _ in X.chunks(batch.column("text")):
                part = batch.slice(at, to - at)
                tokens = encode_both(part.column("text").to_pylist(), path_a, path_b)
                found = align(*tokens, *sizes)
                counts = [np.diff(found.first_a), np.diff(found.first_b), found.n_groups]
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in found.spelled()]
                first = True
                for text, pair, links in chain(found.pairs(len(right.bytes)), [(np.zeros(0, np.int64),) * 3]):
                    if not (first or len(text)):
                        continue
                    rows = np.arange(to - at) if first else np.unique(text)
                    ends = np.searchsorted(text, rows, side="right").astype(np.int32)
                    lists = [pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), pa.array(v, t)) for v, t in ((pair, pa.int64()), (links, pa.int32()))]
                    own = np.bincount(text, links, minlength=to - at).astype(np.int64)[rows]
                    if first:
                        narrow = [pa.array(c, pa.int64()) for c in (*counts, own)] + [pa.array(digests, pa.string())]
                    else:
                        zero = pa.array(np.zeros(len(rows), np.int64))
                        narrow = [zero, zero, zero, pa.array(own), pa.nulls(len(rows), pa.string())]
                    ids = [part.column(c).take(pa.array(rows)) for c in ("rid", "doc_id")]
                    yield pa.RecordBatch.from_arrays([*ids, *narrow, *lists], names)
                    first = False

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.monotonically_increasing_id())
    return plain.mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """(pair, docs, best): the documents that hold a linked id pair, and whether no pair of its A id is in more."""
    counts = saved(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")))
    a = F.floor(F.col("pair") / wide)
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))  # at most one row an A id
    return counts.join(most, a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> tuple[int, pa.Table]:
    """(least count, table) of the most frequent pairs: all with at least that count, at most ``most``."""
    level = F.ceil(F.log2(F.col("docs") + 0.5)).cast("int")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}  # at most 64 rows
    held, least = 0, 1 << 62
    for k in sorted(sizes, reverse=True):
        if held + sizes[k] > most:
            break
        held += sizes[k]
        least = 1 << (k - 1)
    return least, counts.where(F.col("docs") >= least).toArrow()


def measure(docs: DataFrame, path_a: str, path_b: str, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null and empty texts, and texts that either side's tokens do not spell, have zeros and an empty digest. Rows that share a doc_id
    (or text) are documents of their own and count each; null ids stay. A very long text is one task's work, its products are made in
    blocks. An empty table gives no rows; other columns are ignored. Ties for an A id's highest count all count as best.
    """
    rows = saved(aligned(docs, path_a, path_b))
    counts = saved(pair_counts(rows, len(Pieces(path_b).bytes)))
    least, table = _frequent(counts, most_pairs)
    order = np.argsort(table.column("pair").to_numpy())
    held = tuple(table.column(c).to_numpy()[order] for c in ("pair", "docs", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(held)
    names = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'bigint'}" for n in names) + ", pairs array<bigint>, links array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            size = np.diff(lists.offsets.to_numpy())
            keys, links = lists.flatten().to_numpy(), batch.column("links").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            known = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            docs_of = np.where(known, count[at], 0) if len(pair) else np.zeros(len(keys), np.int64)
            is_best = known & best[at] if len(pair) else known
            sums = [np.bincount(row, w, minlength=len(size)).astype(np.int64) for w in (links * is_best, links * docs_of)]
            rest = np.concatenate(([0], np.cumsum(np.bincount(row[~known], minlength=len(size))))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(rest, pa.array(v[~known], t)) for v, t in ((keys, pa.int64()), (links, pa.int32()))]
            made = {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            yield pa.RecordBatch.from_arrays([*(made.get(n, batch.column(n) if n not in made else None) for n in names), *lists], [*names, "pairs", "links"])

    told = saved(rows.mapInArrow(run, schema))
    rest = told.where(F.size("pairs") > 0).select("rid", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("rid", "x.pairs", "x.links")
    rest = rest.join(counts.where(F.col("docs") < least), F.col("pairs") == F.col("pair"))
    zero = [F.lit(0).cast("long").alias(n) for n in ("n_a", "n_b", "n_groups", "n_links")]
    rest = rest.select(
        "rid",
        F.lit(None).cast("long").alias("doc_id"),
        *zero,
        F.when(F.col("best"), F.col("links")).otherwise(0).cast("long").alias("n_best"),
        (F.col("links") * F.col("docs")).alias("count_sum"),
        F.lit(None).cast("string").alias("groups_sha256"),
    )
    both = told.select(*names).union(rest).groupBy("rid")
    sums = [F.sum(n).alias(n) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return both.agg(F.max("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256")).drop("rid")
