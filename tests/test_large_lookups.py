"""A lookup beyond the broadcast limit repeats the entries of hot keys only."""

import pytest
from pyspark.sql import functions as F

from medloom import session as S
from medloom.operators import joins


@pytest.fixture()
def large(spark):
    wanted = {S.BROADCAST_ROWS_CONF: "0", S.HOT_KEY_ROWS_CONF: "50", S.SALT_FACTOR_CONF: "16"}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k in wanted:
        spark.conf.unset(k)


@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_only_hot_keys_are_repeated(spark, large, monkeypatch, how, hot):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 9 != 0, F.when(F.lit(hot) & (F.col("id") % 2 == 0), 3).otherwise(F.col("id"))).alias("k"))
    lookup = spark.range(1, 990).select(F.col("id").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT 3L, -3L"))
    want = sorted(map(tuple, rows.join(lookup, ["k"], how).collect()), key=repr)
    seen = []
    explode = joins.F.explode
    monkeypatch.setattr(joins.F, "explode", lambda c: seen.append(c) or explode(c))
    got = joins.lookup_join(rows, lookup, ["k"], how)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    held = joins.dictionary(rows, lookup, ["k"], "_n")
    copies = held.select(explode(seen[0]).alias("_salt")).count()
    assert copies == held.count() + (2 * 15 if hot else 0)
