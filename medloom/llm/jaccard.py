"""N-gram Jaccard join: exact links between shingle sets, as connected components.

Index lists hold, per shingle, the sets that have it in their prefix, with size and position; whole blocks of a list are
skipped when no pair in them can reach the needed overlap. Sets are grouped by what is already known: equal sets are one,
sets linked with a leader are answered by the leader. A list is read once per group first; afterwards single members of
different groups are compared, and most of these are settled from the leader's answer, as the overlap of x with y is at
most that of x's leader with y plus the shingles in which x differs from its leader.

Shingles are 64-bit hashes. The order of shingles (rare before frequent) steers the work only; any order gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm import text as X
from medloom.llm.cluster import components, saved, small

SHINGLE = 4
PERCENT = 85
KEYS = 4  # minimum hashes that look for leaders
HOT = 64  # shingles in more sets than this are put last
MOST_HOT = 1_000_000  # bound on the shingles put last; HOT is doubled until they fit
BLOCK = 256
ROUNDS = 3
_QUARTER = np.uint64(1 << 62)
_SALTS = [np.uint64(s) for s in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)]


class Sets:
    """Distinct shingles of the rows of a chunk: ``tokens[at[r]:at[r + 1]]``, ascending."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int):
        w = X.words(X.LOWER[data], offsets)
        hashes, count = w.hashes(), w.count
        many = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
        at = np.concatenate(([0], np.cumsum(many)))
        tokens = np.zeros(at[-1], np.uint64)
        grams = X.windows(hashes, size)
        inside = np.flatnonzero(X.within_rows(w.first, size, len(grams)))
        row = w.row_of_word()[inside]
        tokens[at[row] + inside - w.first[row]] = grams[inside]
        for r in np.flatnonzero((count > 0) & (count < size)):
            few = hashes[w.first[r] : w.first[r + 1]]
            tokens[at[r]] = X.windows(few, len(few))[0] ^ np.uint64(len(few))
        for r in range(len(many)):
            tokens[at[r] : at[r + 1]].sort()
        row = np.repeat(np.arange(len(many)), many)
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (row[1:] != row[:-1])
        self.tokens, self.row = tokens[new], row[new]
        self.n = np.bincount(self.row, minlength=len(many))
        self.at = np.concatenate(([0], np.cumsum(self.n)))

    def per_row(self, ufunc: np.ufunc, values: np.ndarray) -> np.ndarray:
        """Reduce token values by row; 0 for empty rows."""
        out = np.zeros(len(self.n), values.dtype)
        full = self.n > 0
        if full.any():
            out[full] = ufunc.reduceat(values, self.at[:-1][full])
        return out


def _prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _isin(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _over_texts(docs: DataFrame, schema: str, make, size: int) -> DataFrame:
    """``make(ids, sets)``, with shingles of ``size`` words, for every chunk of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("text")):
                yield make(batch.column("doc_id").slice(at, to - at), Sets(data, offsets, size))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _fingerprints(ids: pa.Array, s: Sets) -> pa.RecordBatch:
    f1 = s.per_row(np.add, s.tokens)
    f2 = s.per_row(np.add, X.mix(s.tokens ^ _SALTS[0]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(s.n, pa.int64()), _signed(f1), _signed(f2)], ["doc_id", "n", "f1", "f2"]
    )


def _hot(tokens: DataFrame) -> np.ndarray:
    """Shingles in more than HOT sets, sorted; the limit doubles until they fit MOST_HOT."""
    limit = HOT
    counts = saved(tokens.groupBy("token").agg(F.count("*").alias("sets")).where(F.col("sets") > limit))
    while counts.where(F.col("sets") > limit).count() > MOST_HOT:
        limit *= 2
    found = counts.where(F.col("sets") > limit).select("token").toPandas()["token"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def _order(docs: DataFrame, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles: of the quarter of all shingles with the lowest hashes over all documents, and of the others over those
    documents that have too few rare ones in that quarter to fill their prefix."""

    def quarter(ids: pa.Array, s: Sets) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_signed(s.tokens[s.tokens < _QUARTER])], ["token"])

    low = _hot(_over_texts(docs, "token bigint", quarter, size))
    shared = docs.sparkSession.sparkContext.broadcast(low)

    def lacking(ids: pa.Array, s: Sets) -> pa.RecordBatch:
        rare = (s.tokens < _QUARTER) & ~_isin(s.tokens, shared.value)
        short = s.per_row(np.add, rare.astype(np.int64)) < _prefix_length(s.n, percent)
        return pa.RecordBatch.from_arrays([_signed(s.tokens[short[s.row] & (s.tokens >= _QUARTER)])], ["token"])

    return low, _hot(_over_texts(docs, "token bigint", lacking, size))


def _prefixes(docs: DataFrame, low: np.ndarray, high: np.ndarray, size: int, percent: int) -> DataFrame:
    """(doc_id, n, own, k0.., prefix): size, shingles that are not frequent, minimum hashes, prefix in global order."""
    table = docs.sparkSession.sparkContext.broadcast(np.sort(np.concatenate([low, high])))
    schema = "doc_id bigint, n bigint, own bigint, " + "".join(f"k{i} bigint, " for i in range(KEYS)) + "prefix array<bigint>"

    def make(ids: pa.Array, s: Sets) -> pa.RecordBatch:
        hot = _isin(s.tokens, table.value)
        rank = np.where(hot, 2, (s.tokens >= _QUARTER).astype(np.int64))
        order = np.argsort(s.row * 3 + rank, kind="stable")
        place = np.arange(len(order)) - s.at[s.row]
        length = np.where(s.n > 0, _prefix_length(s.n, percent), 0)
        kept = s.tokens[order][place < length[s.row]]
        ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
        prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(kept))
        keys = [_signed(s.per_row(np.minimum, X.mix(s.tokens ^ _SALTS[i]))) for i in range(KEYS)]
        own = s.n - s.per_row(np.add, hot.astype(np.int64))
        batch = pa.RecordBatch.from_arrays(
            [ids, pa.array(s.n, pa.int64()), pa.array(own, pa.int64()), *keys, prefix],
            ["doc_id", "n", "own", *(f"k{i}" for i in range(KEYS)), "prefix"],
        )
        return batch.filter(pa.array(s.n > 0))

    return _over_texts(docs, schema, make, size)


def verify(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Add ``overlap`` and ``linked`` to (a, b) by comparing whole texts; only documents in a pair are read."""
    ids = small(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in X.chunks(batch.column("text_a")):
                x = Sets(data, offsets, size)
                y = Sets(*X.buffers(batch.column("text_b").slice(at, to - at)), size)
                key = np.concatenate([x.tokens, y.tokens])
                row = np.concatenate([x.row, y.row])
                order = np.lexsort((key, row))
                twice = (key[order[1:]] == key[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
                overlap = np.bincount(row[order[1:]][twice], minlength=to - at)
                linked = 100 * overlap >= percent * (x.n + y.n - overlap)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("a").slice(at, to - at),
                        batch.column("b").slice(at, to - at),
                        pa.array(overlap, pa.int64()),
                        pa.array(linked),
                    ],
                    ["a", "b", "overlap", "linked"],
                )

    return both.mapInArrow(run, "a bigint, b bigint, overlap bigint, linked boolean")


def _reachable(nx, px, ny, py, percent: int) -> np.ndarray:
    """Whether two sets whose first common shingle has these positions can reach the needed overlap."""
    return (100 + percent) * np.minimum(nx - px, ny - py) >= percent * (nx + ny)


def _list_pairs(n, pos, doc, group, cut, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs out of consecutive index lists (``cut`` marks where each starts), every list ascending by size."""
    length = np.diff(np.append(np.flatnonzero(cut), len(cut)))
    number = np.repeat(np.arange(len(length)), length)
    long = length[number] > 32
    few = np.flatnonzero(~long)
    for step in range(1, min(32, int(length[length <= 32].max(initial=1)))):
        i, j = few[:-step], few[step:]
        good = (number[i] == number[j]) & (group[i] != group[j]) & _reachable(n[i], pos[i], n[j], pos[j], percent)
        yield doc[i[good]], doc[j[good]]
    for k in np.flatnonzero(length > 32):
        rows = np.flatnonzero(number == k) if len(length) > 1 else np.arange(len(n))
        starts = np.arange(0, len(rows), BLOCK)
        low = np.minimum.reduceat(pos[rows], starts)
        least, most = n[rows][starts], np.append(n[rows][starts[1:] - 1], n[rows][-1])
        for a in range(len(starts)):
            x = rows[starts[a] : starts[a] + BLOCK]
            for b in range(a, len(starts)):
                # sizes ascend, so the needed overlap only grows from here on
                if (100 + percent) * (most[a] - low[a]) < percent * (least[a] + least[b]):
                    break
                if (100 + percent) * min(most[a] - low[a], most[b] - low[b]) < percent * (least[a] + least[b]):
                    continue
                y = rows[starts[b] : starts[b] + BLOCK]
                good = (group[x][:, None] != group[y]) & _reachable(n[x][:, None], pos[x][:, None], n[y], pos[y], percent)
                if a == b:
                    good = np.triu(good, 1)
                i, j = np.nonzero(good)
                yield doc[x[i]], doc[y[j]]


def list_pairs(lists: DataFrame, one_per_group: bool, percent: int = PERCENT) -> DataFrame:
    """Distinct (a, b), a < b, of different groups that an index list cannot rule out.

    ``lists``: (token, n, pos, doc_id, grp). With ``one_per_group`` a list counts each group by its member of least position.
    """

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, n, pos, doc, group = (np.concatenate(p) for p in zip(*parts))
        if one_per_group:
            order = np.lexsort((pos, group, token))
            first = np.ones(len(order), bool)
            first[1:] = (token[order[1:]] != token[order[:-1]]) | (group[order[1:]] != group[order[:-1]])
            keep = order[first]
            token, n, pos, doc, group = token[keep], n[keep], pos[keep], doc[keep], group[keep]
        order = np.lexsort((n, token))
        token, n, pos, doc, group = token[order], n[order], pos[order], doc[order], group[order]
        cut = np.ones(len(token), bool)
        cut[1:] = token[1:] != token[:-1]
        for i, j in _list_pairs(n, pos, doc, group, cut, percent):
            if len(i):
                pair = np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("token", "n", "pos", "doc_id", "grp")]
            if not len(columns[0]):
                continue
            # the last list may go on in the next batch
            change = int(np.searchsorted(columns[0], columns[0][-1], side="left"))
            if change:
                yield from flush([*held, [c[:change] for c in columns]])
                held = []
            held.append([c[change:] for c in columns])
        if held:
            yield from flush(held)

    ordered = lists.select("token", "n", "pos", "doc_id", "grp").repartition("token").sortWithinPartitions("token")
    return ordered.mapInArrow(run, "a bigint, b bigint").where("a <> b").distinct()


def _grouped(lists: DataFrame, roots: DataFrame) -> DataFrame:
    known = lists.join(small(roots.withColumnRenamed("node", "doc_id")), "doc_id", "left")
    return known.withColumn("grp", F.coalesce("root", "doc_id")).drop("root")


def _answered(pairs: DataFrame, checked: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs left after the leaders' answers: overlap(x, y) <= overlap(leader, y) + |x| - overlap(leader, x)."""
    own = checked.where("linked").select(F.col("a").alias("l"), F.col("b").alias("x"), "overlap").union(
        checked.where("linked").select("b", "a", "overlap")
    )
    lead = own.groupBy("x").agg(F.max(F.struct("overlap", "l")).alias("m")).select("x", "m.l", F.col("m.overlap").alias("lx"))
    told = checked.select(F.col("a").alias("l"), F.col("b").alias("y"), F.col("overlap").alias("ly")).union(
        checked.select("b", "a", "overlap")
    )
    out = pairs
    for x, y in (("a", "b"), ("b", "a")):
        s = sizes.select(F.col("doc_id").alias("sx"), F.col("n").alias("nx"))
        t = sizes.select(F.col("doc_id").alias("sy"), F.col("n").alias("ny"))
        out = out.alias("p").join(lead.alias("q"), F.col(f"p.{x}") == F.col("q.x"), "left")
        out = out.join(told.alias("t"), (F.col("t.l") == F.col("q.l")) & (F.col("t.y") == F.col(f"p.{y}")), "left")
        out = out.join(s, F.col(f"p.{x}") == F.col("sx")).join(t, F.col(f"p.{y}") == F.col("sy"))
        bound = F.col("ly") + F.col("nx") - F.col("lx")
        out = out.where(F.col("ly").isNull() | ((100 + percent) * bound >= percent * (F.col("nx") + F.col("ny")))).select("p.a", "p.b")
    return out


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Words lower-cased in A-Z; sets of distinct shingles of ``size`` words, of a shorter text its whole word sequence. Linked: Jaccard
    similarity of at least ``percent``. ``component_id`` is the least doc_id reachable by links, itself included. Null or empty texts
    have no shingles and no links. Rows that share a doc_id are one node; a null doc_id links with nothing and has a null
    component. An empty table gives no rows; other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = plain.where("doc_id is not null")
    slim = saved(_over_texts(plain, "doc_id bigint, n bigint, f1 bigint, f2 bigint", _fingerprints, size))
    full = slim.where("n > 0 and doc_id is not null")
    first = full.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    first = first.where("rep <> last")
    copies = saved(full.join(first, ["n", "f1", "f2"]).where("doc_id <> rep").select("doc_id", "rep").distinct())
    # copies need no index entries of their own, unless their id has another set as well
    one = F.struct("n", "f1", "f2")
    several = saved(full.groupBy("doc_id").agg(F.min(one).alias("x"), F.max(one).alias("y")).where("x <> y").select("doc_id"))
    told = saved(copies.select("doc_id").distinct().join(several, "doc_id", "left_anti"))
    single = known.join(small(told), "doc_id", "left_anti")
    sets = saved(_prefixes(single, *_order(single, size, percent), size, percent))
    sizes = sets.select("doc_id", "n").groupBy("doc_id").agg(F.max("n").alias("n"))

    # leaders: of the sets that share a minimum hash, the one with the fewest shingles of its own
    seen = None
    for i in range(KEYS):
        best = sets.groupBy(f"k{i}").agg(F.min(F.struct("own", "doc_id", "n")).alias("l"), F.count("*").alias("c"))
        near = sets.join(best.where("c > 1"), f"k{i}").where(
            (F.col("doc_id") != F.col("l.doc_id"))
            & (100 * F.least("n", "l.n") >= percent * F.greatest("n", "l.n"))
        )
        pairs = near.select(F.least("doc_id", "l.doc_id").alias("a"), F.greatest("doc_id", "l.doc_id").alias("b"))
        seen = pairs if seen is None else seen.union(pairs)
    checked = saved(verify(saved(seen.distinct()), known, size, percent))

    equal = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = lambda: checked.where("linked").select("a", "b").union(equal)
    roots = saved(components(links()))

    token = sets.select("doc_id", "n", F.posexplode("prefix").alias("pos", "token"))
    alone = F.expr("lag(pos) over (partition by token order by n) is null and lead(pos) over (partition by token order by n) is null")
    lists = saved(token.withColumn("pos", F.col("pos").cast("long")).withColumn("alone", alone).where("not alone").drop("alone"))
    for step in range(ROUNDS + 1):
        last = step == ROUNDS
        pairs = list_pairs(_grouped(lists, roots), one_per_group=not last, percent=percent).join(checked, ["a", "b"], "left_anti")
        if last:
            # a leader's answer speaks for one set of an id, so ids of several sets are compared themselves
            own = small(several)
            kept = pairs.join(own, F.col("a") == F.col("doc_id"), "left_semi").union(pairs.join(own, F.col("b") == F.col("doc_id"), "left_semi"))
            pairs = _answered(pairs, checked, sizes, percent).union(kept).distinct()
        pairs = saved(pairs)
        if pairs.isEmpty():
            if last:
                break
            continue
        new = saved(verify(pairs, known, size, percent))
        checked = saved(checked.union(new))
        if not new.where("linked").isEmpty():
            roots = saved(components(links()))
    found = roots.groupBy("node").agg(F.min("root").alias("root"))
    out = slim.join(found, slim["doc_id"] == found["node"], "left")
    return out.select(slim["doc_id"], F.col("n").alias("n_shingles"), F.coalesce("root", slim["doc_id"]).alias("component_id"))
