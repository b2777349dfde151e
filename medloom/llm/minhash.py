"""Near-duplicates by minimum hashes with tensored banding.

Two small collections of BLOCKS hash blocks each (BAND minimum hashes a block) stand for BLOCKS * BLOCKS tables: the key of table
(i, j) is block i of the first collection with block j of the second, so 2 * BLOCKS * BAND minimum hashes do for a table set that
would take BLOCKS * BLOCKS * 2 * BAND by itself. A pair of similarity s is missed with about 2 * (1 - s ** BAND) ** BLOCKS:
2e-5 at 0.85. A key is shared only if both its blocks are, so blocks held by one set go before keys are formed.

Equal sets are one from the start. Of the sets with one key all meet the one whose blocks are the most common (the middle of a
group of copies); what this leaves outside the leader's component meets the others of the key, each pair at its first common key.
Candidates agree in nearly as many minimum hashes as linked pairs do (six standard deviations less), and the parities of their
shingles in PARITIES cells differ no more than the shingles themselves may (a bound, nothing is lost by it). All are then confirmed
on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X
from medloom.llm.cluster import components, saved, small
from medloom.llm.jaccard import Sets

SHINGLE = 5
PERCENT = 85
BLOCKS = 12  # hash blocks of each of the two collections
BAND = 3  # minimum hashes of a block
MINIMA = 2 * BLOCKS * BAND
LONGS = MINIMA // 8  # a byte of every minimum hash, eight to a number
PARITIES = 576  # cells whose parity of shingles is kept, 64 to a number
SKETCH = [*(f"s{k}" for k in range(LONGS)), *(f"o{k}" for k in range(PARITIES // 64))]
_FACTORS = np.random.default_rng(20240613).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = np.uint64(0x9FB21C651E98DF25)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _identity(s: Sets) -> np.ndarray:
    """A number for each set, made of its size and two sums over its shingles."""
    both = s.per_row(np.add, s.tokens) ^ X.mix(s.per_row(np.add, X.mix(s.tokens ^ _SALT)))
    return X.mix(both + s.n.astype(np.uint64))


def minima(s: Sets) -> Iterator[np.ndarray]:
    """MINIMA minimum hashes of every set of a chunk."""
    for factor in _FACTORS:
        yield X.mix(s.per_row(np.minimum, s.tokens * factor))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, sid, s0.., o0.., u, v) of every row: set size, set number, a byte of each minimum hash, parities, block hashes of
    both collections.

    The lowest bit of a block hash tells its collection.
    """
    names = ["doc_id", "n", "sid", *SKETCH, "u", "v"]
    schema = ", ".join(f"{c} {'array<bigint>' if c in 'uv' else 'bigint'}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("text")):
                s = Sets(data, offsets, size)
                rows = to - at
                packed = np.zeros((rows, MINIMA), np.uint8)
                blocks = np.zeros((rows, 2 * BLOCKS), np.uint64)
                for k, least in enumerate(minima(s)):
                    packed[:, k] = least & np.uint64(0xFF)
                    block = blocks[:, k // BAND]
                    block[:] = X.mix(block * np.uint64(0xD6E8FEB86659FD93) + least + np.uint64(k))
                blocks[:, :BLOCKS] &= ~np.uint64(1)
                blocks[:, BLOCKS:] |= np.uint64(1)
                cells = np.bincount(s.row * PARITIES + (s.tokens % np.uint64(PARITIES)).astype(np.int64), minlength=rows * PARITIES)
                odd = np.packbits((cells & 1).astype(bool)).reshape(rows, PARITIES // 8)
                longs = np.concatenate([packed, odd], axis=1).view(np.uint64)
                ends = pa.array(np.arange(rows + 1, dtype=np.int32) * BLOCKS)
                halves = [pa.ListArray.from_arrays(ends, _signed(h.reshape(-1))) for h in (blocks[:, :BLOCKS], blocks[:, BLOCKS:])]
                columns = [pa.array(s.n, pa.int64()), _signed(_identity(s)), *(_signed(longs[:, k]) for k in range(len(SKETCH))), *halves]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, rows), *columns], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _least_agreeing(percent: int) -> int:
    p = percent / 100
    return max(0, math.floor(MINIMA * p - 6 * math.sqrt(MINIMA * p * (1 - p))))


def _near_parity(x: str, y: str, percent: int) -> Column:
    """Sizes and parities allow the similarity."""
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    apart = sum(F.bit_count(F.col(f"{x}.o{k}").bitwiseXOR(F.col(f"{y}.o{k}"))) for k in range(PARITIES // 64))
    least = F.expr(f"({percent} * ({x}.n + {y}.n) + {99 + percent}) div {100 + percent}")  # shingles that linked sets share
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (apart <= a + b - 2 * least)


def _agreeing(x: str, y: str, percent: int) -> Column:
    """Enough minimum hashes agree."""
    differing = None
    for k in range(LONGS):
        d = F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))
        for step in (4, 2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
        count = F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))
        differing = count if differing is None else differing + count
    return differing <= MINIMA - _least_agreeing(percent)


def _texts(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(sid, text) once for every set of the documents ``ids`` (doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("text")):
                s = Sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays([_signed(_identity(s)), batch.column("text").slice(at, to - at)], ["sid", "text"])

    found = docs.select("doc_id", "text").join(small(ids), "doc_id", "left_semi").select("text").mapInArrow(run, "sid bigint, text string")
    return found.groupBy("sid").agg(F.first("text").alias("text"))


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, overlap, linked) of pairs of sets, by their whole shingle sets; the texts of ``a`` travel once, those of ``b`` with the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("text_b")):
                x = Sets(data, offsets, size)
                lead = batch.column("text_a").slice(at, to - at)
                for lo, hi, data_a, offsets_a in X.chunks(lead):
                    y = Sets(data_a, offsets_a, size)
                    own = slice(x.at[lo], x.at[hi])
                    key, row = np.concatenate([x.tokens[own], y.tokens]), np.concatenate([x.row[own] - lo, y.row])
                    order = np.lexsort((key, row))
                    key, row = key[order], row[order]
                    twice = (key[1:] == key[:-1]) & (row[1:] == row[:-1])
                    overlap = np.bincount(row[1:][twice], minlength=hi - lo)
                    linked = 100 * overlap >= percent * (x.n[lo:hi] + y.n - overlap)
                    ids = [batch.column(c).slice(at + lo, hi - lo) for c in ("a", "b")]
                    yield pa.RecordBatch.from_arrays([*ids, pa.array(overlap, pa.int64()), pa.array(linked)], ["a", "b", "overlap", "linked"])

    both = pairs.select("a", "b").join(texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint, overlap bigint, linked boolean")


def keys(sets: DataFrame) -> DataFrame:
    """(key, sid, fame): the table keys of every set whose two blocks are both shared; fame counts who shares its blocks."""
    halves = saved(sets.select("sid", F.explode(F.concat("u", "v")).alias("half")))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1")
    held = halves.join(shared, "half")
    first = F.col("half").bitwiseAND(F.lit(1)) == 0
    each = held.groupBy("sid").agg(  # at most BLOCKS of each collection
        F.collect_list(F.when(first, F.col("half"))).alias("u"),
        F.collect_list(F.when(~first, F.col("half"))).alias("v"),
        F.sum("c").alias("fame"),
    )
    each = each.select("sid", "fame", F.explode("u").alias("x"), "v").select("sid", "fame", "x", F.explode("v").alias("y"))
    return each.select(F.xxhash64("x", "y").alias("key"), "sid", "fame")


def links(docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of linked sets, enough of them to hold every component together."""
    table = saved(keys(sets))
    lead = saved(table.groupBy("key").agg(F.max(F.struct("fame", "sid")).alias("l"), F.count("*").alias("c")).where("c > 1").select("key", "l.sid"))
    narrow = sets.select("sid", "n", *SKETCH)

    def plausible(pairs: DataFrame) -> DataFrame:
        both = pairs.join(narrow.alias("x"), F.col("a") == F.col("x.sid")).join(narrow.alias("y"), F.col("b") == F.col("y.sid"))
        return both.where(_near_parity("x", "y", percent) & _agreeing("x", "y", percent)).select("a", "b")

    meet = table.alias("t").join(lead.alias("l"), "key").where("t.sid <> l.sid").select(F.col("l.sid").alias("a"), F.col("t.sid").alias("b"))
    pairs = saved(plausible(meet.distinct()))

    def confirmed(pairs: DataFrame) -> DataFrame:
        used = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
        ids = saved(sets.join(small(used), "sid", "left_semi").select(F.col("rep").alias("doc_id")).distinct())
        return saved(confirm(pairs, saved(_texts(docs, ids, size)), size, percent))

    checked = confirmed(pairs)
    found = checked.where("linked").select("a", "b")
    roots = saved(components(found))
    # what is not in the leader's component meets all others of its key
    known = lambda df: df.alias("t").join(roots.withColumnRenamed("node", "sid").alias("r"), "sid", "left")
    rooted = known(table.select("key", "sid")).select("key", "sid", F.coalesce("r.root", "sid").alias("root"))
    leaders = known(lead).select("key", F.coalesce("r.root", "sid").alias("lead"))
    rooted = saved(rooted.join(leaders, "key"))
    mixed = saved(rooted.where("root <> lead").select("key").distinct())
    rooted = saved(rooted.join(mixed, "key", "left_semi").join(sets.select("sid", "n", *SKETCH, "u", "v"), "sid"))
    odd, every = rooted.where("root <> lead").alias("o"), rooted.alias("m")
    first = F.xxhash64(*(F.get(F.array_intersect(f"o.{c}", f"m.{c}"), F.lit(0)) for c in "uv"))
    rest = odd.join(
        every,
        (F.col("o.key") == F.col("m.key"))
        & F.expr("o.root <> m.root and (m.root = m.lead or o.sid < m.sid)")
        & _near_parity("o", "m", percent)
        & (first == F.col("o.key")),
    )
    rest = rest.select(F.col("m.sid").alias("a"), F.col("o.sid").alias("b"))
    done = checked.select("a", "b").union(checked.select("b", "a"))
    # found at one key as (odd, leader's) and at another as (odd, odd), a pair may come twice
    rest = saved(plausible(rest.join(done, ["a", "b"], "left_anti").distinct()))
    if rest.isEmpty():
        return found
    return found.union(confirmed(rest).where("linked").select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words lower-cased in A-Z; sets of distinct shingles of ``size`` words, of a shorter text its whole word sequence. Linked: Jaccard
    similarity of at least ``percent``. ``component_id`` is the least doc_id reachable by links, itself included; ``kept`` holds for
    that document of each component. Null, empty and blank texts have no shingles and no links. Rows that share a doc_id are one
    document, whether equal or not: a link of one row is a link of all, and all are kept or none. A null doc_id links with nothing,
    has a null component and is kept. Very long texts are used whole. An empty table gives no rows; other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = saved(signatures(plain, size))
    full = rows.where("n > 0 and doc_id is not null")
    wide = ["n", *SKETCH, "u", "v"]
    sets = saved(full.groupBy("sid").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in wide)))
    found = links(plain.where("doc_id is not null"), sets, size, percent)
    # sets of one document hang together
    own = full.groupBy("doc_id").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a <> b").select("doc_id", "a")
    tied = full.select("doc_id", "sid").join(small(saved(own)), "doc_id").select("a", F.col("sid").alias("b")).where("a <> b").distinct()
    roots = components(saved(found.union(tied))).groupBy("node").agg(F.min("root").alias("root"))
    held = sets.select("sid", "rep").join(roots, F.col("sid") == F.col("node"), "left").select("sid", "rep", F.coalesce("root", "sid").alias("root"))
    held = saved(held)
    least = held.groupBy("root").agg(F.min("rep").alias("least"))
    of_set = saved(held.join(least, "root").select("sid", "least"))
    of_doc = full.select("doc_id", "sid").join(of_set, "sid").groupBy("doc_id").agg(F.min("least").alias("least"))
    out = rows.select("doc_id", "n").join(of_doc.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("id"), "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
