"""Joins and picks that hold when one key owns a large share of the rows.

* A lookup side is broadcast only after its rows were counted against a limit.
* Beyond the limit the rows are written once, so that whatever made them runs once however many lookups follow. In inner and semi
  joins a broadcast bitmap of the lookup's keys keeps most rows that meet nothing out of that table. The lookup is cut to
  the keys that they hold (distinct keys are few even where rows are many), written out and counted again: rows then meet a
  narrow dictionary and are not shuffled.
* Only where that dictionary is too large as well, both sides are shuffled; the entries of hot keys alone are repeated ``salt``
  times and their rows spread over the copies, so the dictionary does not grow by that factor.
* Between two large sides only the hot keys are spread; there are at most rows / hotKeyRows of them. A side is written once
  before its keys are counted, so counting reads the key columns of a table and nothing below it runs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom import session as S


def _row_salt(df: DataFrame, copies: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(copies)).cast("int")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group. Spark limits every group before the shuffle (WindowGroupLimit),

    so a hot group sends one row per task, not all of its rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


# A bitmap has so many bits for a key, so that one row in sixteen that meets nothing is kept; at most MOST_BITS (32 MiB) are broadcast.
KEY_BITS = 16
MOST_BITS = 1 << 28
_SKETCHED = ("string", "int", "bigint", "date")


def _place_of_key(on: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*on).bitwiseAND(F.lit(bits - 1))


def may_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left`` less most of the rows whose key ``right`` (a written table) lacks; every row that has a match stays.

    The hashed keys of ``right`` set bits of a bitmap, which is broadcast in blocks of 64 words. Keys of other types than text, whole
    numbers and dates, or of two types, are not filtered.
    """
    kinds = [[side.schema[k].dataType.simpleString() for k in on] for side in (left, right)]
    if kinds[0] != kinds[1] or any(kind not in _SKETCHED for kind in kinds[0]):
        return left
    bits = 4096
    wanted = min(MOST_BITS, KEY_BITS * right.count())
    while bits < wanted:
        bits *= 2
    at = right.where(~_any_null(on)).select(_place_of_key(on, bits).alias("_at"))
    word = at.groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(_at & 63 AS INT)))").alias("_bits"))
    entry = F.struct(F.col("_word").bitwiseAND(F.lit(63)), F.col("_bits"))
    block = word.groupBy(F.shiftright("_word", 6).alias("_block")).agg(F.map_from_entries(F.collect_list(entry)).alias("_map"))
    words = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long")), lambda i: F.coalesce(F.try_element_at("_map", i), F.lit(0)))
    block = block.select("_block", words.alias("_words"))
    place = _place_of_key(on, bits)
    word = F.get("_words", F.shiftright(place, 6).bitwiseAND(F.lit(63)).cast("int"))
    held = F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1
    return left.join(F.broadcast(block), (F.shiftright(place, 12) == F.col("_block")) & held).drop("_block", "_words")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: bool | None = None,
    stored: bool = False,
) -> DataFrame:
    """Join rows to a lookup table on equally named columns. ``stored`` rows are a written table already."""
    if small if small is not None else S.fits_broadcast(right):
        return left.join(F.broadcast(right), list(on), how)
    if not stored:
        if how in ("inner", "left_semi"):
            right = S.written(right)
            left = may_match(left, right, on)
        left = S.written(left)
    held = dictionary(left, right, on, "_n")
    if S.fits_broadcast(held):
        return left.join(F.broadcast(held.drop("_n")), list(on), how)
    spark = left.sparkSession
    copies = S.conf_int(spark, S.SALT_FACTOR_CONF, S.SALT_FACTOR_DEFAULT)
    busy = F.col("_n") > S.conf_int(spark, S.HOT_KEY_ROWS_CONF, S.HOT_KEY_ROWS_DEFAULT)
    # at most rows / hotKeyRows keys, so their table is small by itself
    hot = S.written(held.where(busy).select(*on, F.lit(True).alias("_hot")).distinct())
    # Rows without a key match nothing, so they need no copy and may go anywhere.
    salt = F.when(_any_null(on), _row_salt(left, copies * 1000) + F.lit(copies))
    if hot.isEmpty():
        salted = left.withColumn("_salt", salt.otherwise(F.lit(0)))
    else:
        salt = salt.when(F.col("_hot"), _row_salt(left, copies)).otherwise(F.lit(0))
        salted = left.join(hot, list(on), "left").withColumn("_salt", salt).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(copies - 1))
    repeated = held.withColumn("_salt", F.explode(F.when(busy, every).otherwise(F.array(F.lit(0))))).drop("_n")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def dictionary(rows: DataFrame, lookup: DataFrame, on: Sequence[str], count: str | None = None) -> DataFrame:
    """The part of a large lookup table whose keys occur in ``rows``, written to the shared folder.

    Each key is looked up once, however many rows hold it: keys are made distinct per task before they are shuffled, and only
    the key columns of ``rows`` are read. NULL keys match nothing and are left out. ``count`` names a column for the key's rows.
    """
    keys = rows.select(*on).where(~_any_null(on))
    if count is None:
        return S.written(lookup.join(keys.distinct(), list(on), "left_semi"))
    return S.written(lookup.join(keys.groupBy(*on).agg(F.count(F.lit(1)).alias(count)), list(on)))


def _equi(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, residual: Column | None
) -> DataFrame:
    if residual is None:
        return left.join(right, list(on), how)
    renamed = right.withColumnsRenamed({k: "_r_" + k for k in on})
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col("_r_" + k) for k in on])
    return left.join(renamed, same & residual, how).drop(*["_r_" + k for k in on])


def _place_salt(copies: int) -> Column:
    """A copy number by the row's place in a written table: the same in every attempt, and different for equal rows."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(copies)).cast("int")


def _hot_keys(df: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Keys with more rows than the limit; at most rows / limit of them, which bounds their broadcast."""
    limit = S.conf_int(df.sparkSession, S.HOT_KEY_ROWS_CONF, S.HOT_KEY_ROWS_DEFAULT)
    counts = df.where(~_any_null(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > limit).select(*on, F.lit(True).alias(flag))


def keyed_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", residual: Column | None = None
) -> DataFrame:
    """Join two large sides on equally named columns (and a residual test). Small inputs join plainly.

    A key that is hot on the left has its left rows spread over copies of its right rows. In inner joins a key that is hot on
    the right alone is spread the other way round; outer and semi joins must see each left row once, so they leave it.
    """
    both_ways = how == "inner" and S.may_be_skewed(right)
    if not both_ways and not S.may_be_skewed(left):
        return _equi(left, right, on, how, residual)
    copies = S.conf_int(left.sparkSession, S.SALT_FACTOR_CONF, S.SALT_FACTOR_DEFAULT)
    left = S.written(left)
    hot = _hot_keys(left, on, "_hot")
    if both_ways:
        right = S.written(right)
        hot = hot.join(_hot_keys(right, on, "_hot_right"), list(on), "full")
    else:
        hot = hot.withColumn("_hot_right", F.lit(None).cast("boolean"))
    hot = S.written(hot)
    every = F.sequence(F.lit(0), F.lit(copies - 1))
    own, one = F.array(_place_salt(copies)), F.array(F.lit(0))
    anywhere = F.array(_place_salt(copies * 1000) + F.lit(copies))

    def spread(side: DataFrame, salts: Column) -> DataFrame:
        marked = side.withColumns({"_own": own, "_anywhere": anywhere}).join(F.broadcast(hot), list(on), "left")
        return marked.withColumn("_salt", F.explode(salts)).drop("_hot", "_hot_right", "_own", "_anywhere")

    salted = spread(
        left,
        F.when(F.col("_hot"), F.col("_own"))
        .when(F.col("_hot_right"), every)
        .when(_any_null(on), F.col("_anywhere"))
        .otherwise(one),
    )
    if both_ways:
        right_salts = F.when(F.col("_hot"), every).when(F.col("_hot_right"), F.col("_own")).otherwise(one)
        repeated = spread(right, right_salts)
    else:
        repeated = right.join(F.broadcast(hot), list(on), "left").withColumn(
            "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(one))
        ).drop("_hot", "_hot_right")
    return _equi(salted, repeated, [*on, "_salt"], how, residual).drop("_salt")


# Levels of dyadic blocks: 2**23 days reach from the year 1 beyond the year 9999.
_LEVELS = 23


def period_blocks(start: Column, end: Column) -> Column:
    """The fewest dyadic blocks of days (level, block) that cover a period, both ends included: at most two a level.

    Block number b of level k holds the days b * 2**k to (b + 1) * 2**k - 1. At level k only a block at the left end
    with an odd number, or one before an odd right bound, is not part of a larger block that also lies inside.
    """
    first, past = F.unix_date(start), F.unix_date(end) + 1
    found = []
    for level in range(_LEVELS):
        low = -F.shiftright(-first, level)  # rounded up
        high = F.shiftright(past, level)
        odd = lambda c: c.bitwiseAND(F.lit(1)) == 1
        for block, fits in ((low, odd(low)), (high - 1, odd(high))):
            entry = F.struct(F.lit(level).alias("level"), block.alias("block"))
            found.append(F.when((low < high) & fits, entry))
    return F.array_compact(F.array(*found))


def within_period(
    points: DataFrame,
    periods: DataFrame,
    on: Sequence[str],
    day: str,
    start: str,
    end: str,
    how: str = "inner",
) -> DataFrame:
    """Rows joined to the periods (both ends included) that hold their date.

    A period is cut into dyadic blocks of days, about 2 log2(days) rows however long it is; the distinct dates of a key
    look up one block of every level that occurs (at most 23). A date and a period share exactly one block, so no test of the dates is
    left. What is found is joined to the rows by key and date; a left join keeps rows without a period once.
    """
    if S.may_be_skewed(points):
        points = S.written(points)
    blocks = (
        periods.where(F.col(start) <= F.col(end))
        .withColumn("_block", F.explode(period_blocks(F.col(start), F.col(end))))
        .withColumns({"_level": F.col("_block.level"), "_block": F.col("_block.block")})
    )
    levels = sorted(r[0] for r in blocks.select("_level").distinct().collect())
    asked = points.select(*on, day).where(~_any_null([*on, day])).distinct()
    looked = F.array(*[F.lit(k) for k in levels]) if levels else F.array().cast("array<int>")
    asked = asked.withColumn("_level", F.explode(looked))
    asked = asked.withColumn("_block", F.expr(f"shiftright(unix_date(`{day}`), _level)"))
    held = keyed_join(asked, blocks, [*on, "_level", "_block"]).drop("_level", "_block")
    return keyed_join(points, held, [*on, day], how)
