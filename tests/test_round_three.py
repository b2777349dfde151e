"""Large lookups by a dictionary of the codes in use; route counts."""

import pyspark.sql.functions as F
import pytest

from medloom import session as S
from medloom.operators import joins
from medloom.operators import terminology as V


@pytest.fixture
def limits(spark):
    """Sets limits and takes them back."""
    kept = []

    def put(**values):
        for name, value in values.items():
            key = f"spark.medloom.{name}"
            kept.append(key)
            spark.conf.set(key, str(value))

    yield put
    for key in kept:
        spark.conf.unset(key)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [1000, 20, 0])
def test_lookup_by_dictionary(spark, limits, how, limit):
    rows = spark.createDataFrame([(i, "v" if i % 3 else None, f"c{i % 5}") for i in range(60)] + [(60, "w", "none")], "id int, vocab string, code string")
    lookup = spark.createDataFrame([("v", f"c{i}", i * 10 + j) for i in range(40) for j in range(2)], "vocab string, code string, target int")
    want = sorted(map(tuple, rows.join(lookup, ["vocab", "code"], how).collect()), key=repr)
    limits(broadcastRows=limit, saltFactor=3)
    got = joins.lookup_join(rows, lookup, ["vocab", "code"], how)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    plan = _plan(got)
    # a dictionary that fits is broadcast: no copies of the lookup, no shuffle of the rows
    assert ("_salt" in plan) == (limit == 0) and ("strategy=broadcast" in plan) == (limit != 0)


def test_dictionary_holds_codes_in_use(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("z", 4)], "code string, n int")
    lookup = spark.createDataFrame([("a", 7), ("a", 8), ("b", 9), (None, 10)], "code string, target int")
    assert sorted(r["target"] for r in joins.dictionary(rows, lookup, ["code"]).collect()) == [7, 8]
    assert joins.dictionary(rows.limit(0), lookup, ["code"]).count() == 0


def test_route_counts(spark):
    rows = [("1", 5, "Condition"), ("1", 5, "Condition"), ("2", 6, "Drug"), ("3", 7, None)]
    family = spark.createDataFrame(rows, "id string, std_concept_id int, std_domain string")
    got = {r["route"]: (r["n"], r["row_keys"]) for r in V.route_counts(family, ["Condition", "Procedure"]).collect()}
    assert got == {"Condition": (2, 1), "Procedure": (0, 0), "unrouted": (2, 2)}
    assert S.fits_broadcast(family)
    assert V.route_counts(family.where(F.lit(False)), ["Condition"]).agg(F.sum("n")).first()[0] == 0
