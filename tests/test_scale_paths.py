"""The large-data strategies give the same rows as the plain ones."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from medloom import session as S
from medloom.operators import joins as J

DATA = "/root/testdata/sf0.001"


@pytest.fixture()
def careful(spark):
    """No broadcasts, every join treated as large, every busy key hot."""
    wanted = {S.BROADCAST_ROWS_CONF: "0", S.SALT_BYTES_CONF: "-1", S.HOT_KEY_ROWS_CONF: "5", S.SALT_FACTOR_CONF: "4"}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k in wanted:
        spark.conf.unset(k)


def _sides(spark):
    rng = random.Random(1)
    left = [(i, None if i % 11 == 0 else (1 if i % 3 == 0 else rng.randint(0, 40))) for i in range(400)]
    right = [(k % 30, f"v{k}") for k in range(45)]
    return (
        spark.createDataFrame(left, "id int, k int"),
        spark.createDataFrame(right, "k int, v string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_joins_equal_plain_joins(spark, careful, how):
    left, right = _sides(spark)
    plain = rows(left.join(right, ["k"], how), *left.join(right, ["k"], how).columns)
    names = left.join(right, ["k"], how).columns
    assert rows(J.lookup_join(left, right, ["k"], how), *names) == plain
    assert rows(J.keyed_join(left, right, ["k"], how), *names) == plain


def test_period_join_equals_nested_loop(spark, careful):
    rng = random.Random(2)
    points = [(i, rng.randint(0, 3), rng.randint(0, 300)) for i in range(300)]
    spans = []
    for i in range(40):
        a = rng.randint(0, 280)
        spans.append((i, rng.randint(0, 3), a, a + rng.randint(-3, 90)))
    p = spark.createDataFrame(points, "id int, g int, d int").selectExpr("id", "g", "date_from_unix_date(d) AS d")
    s = spark.createDataFrame(spans, "sid int, g int, a int, b int").selectExpr(
        "sid", "g", "date_from_unix_date(a) AS a", "date_from_unix_date(b) AS b"
    )
    want = []
    for i, g, d in points:
        hits = [sid for sid, g2, a, b in spans if g2 == g and a <= d <= b]
        want += [(i, h) for h in hits] or [(i, None)]
    got = rows(J.within_period(p, s, ["g"], "d", "a", "b", "left"), "id", "sid")
    assert got == sorted(want, key=repr)


def test_period_blocks_cover_every_day_once(spark):
    rng = random.Random(3)
    pairs = [(0, 0), (-1, 0), (-40, 41), (19_000, 2_932_896), (-719_162, 2_932_896)]
    pairs += [(a, a + rng.randint(0, 400)) for a in (rng.randint(-500, 500) for _ in range(60))]
    frame = spark.createDataFrame(pairs, "a int, b int")
    days = [f"date_from_unix_date({c})" for c in "ab"]
    for a, b, blocks in frame.select("a", "b", J.period_blocks(F.expr(days[0]), F.expr(days[1]))).collect():
        runs = sorted((n << level, (n + 1) << level) for level, n in blocks)
        assert (runs[0][0], runs[-1][1]) == (a, b + 1)
        assert all(x[1] == y[0] for x, y in zip(runs, runs[1:]))
        assert len(runs) <= 2 * (b - a + 1).bit_length()


def test_open_periods_stay_few_rows(spark, careful):
    points = spark.sql("SELECT 1 AS g, date'2020-05-01' AS d UNION ALL SELECT 1, NULL UNION ALL SELECT NULL, date'2020-05-01'")
    spans = spark.sql("SELECT 1 AS g, date'1900-01-01' AS a, date'9999-12-31' AS b UNION ALL SELECT 1, NULL, date'2021-01-01'")
    got = rows(J.within_period(points, spans, ["g"], "d", "a", "b", "left"), "g", "b")
    assert len(got) == 3 and sum(b is not None for _, b in got) == 1
    assert J.within_period(points, spans.limit(0), ["g"], "d", "a", "b", "left").count() == 3
    assert J.within_period(points.limit(0), spans, ["g"], "d", "a", "b").count() == 0


def _leaves(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_chained_joins_do_not_repeat_their_inputs(spark, careful):
    left, right = _sides(spark)
    joined = left
    for n in range(4):
        joined = J.keyed_join(joined, right.withColumnRenamed("v", f"v{n}"), ["k"], "left")
    # the written left side, the right side and the table of hot keys beside each
    assert _leaves(joined) == 4


def test_hot_right_side_is_spread(spark, careful):
    left = spark.createDataFrame([(i, i) for i in range(20)], "id int, k int")
    right = spark.createDataFrame([(7, "same")] * 500 + [(k, "v") for k in range(20)], "k int, v string")
    got = J.keyed_join(left, right, ["k"])
    assert rows(got, "id", "v") == rows(left.join(right, ["k"]), "id", "v")
    salts = J.keyed_join(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_hot_right" in salts


@pytest.mark.parametrize(
    "name",
    [
        "edge_condition_occurrence",
        "edge_observation_measurement",
        "edge_immunization",
        "visit_final",
        "drug_era",
        "csv_drug_exposure",
        "csv_cost",
        "visit_assignment",
        "search_references",
    ],
)
def test_registered_queries_without_broadcast(spark, careful, name):
    from __spark_entry__ import oracle_sql, queries
    from checks import mirror
    from checks.compare import check

    mirror._seen.clear()
    ok, note = check(spark, DATA, queries()[name], oracle_sql()[name])
    mirror._seen.clear()
    assert ok, note
