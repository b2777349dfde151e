"""Routing checks shuffle a key once."""

from helpers import rows

from medloom.operators import quality as QL


def test_misrouted_shuffles_keys_once(spark):
    part = spark.range(100).selectExpr("concat('k', id) AS row_key")
    branches = {"b": part.where("row_key < 'k5'"), "a": part.where("row_key > 'k3'"), "c": part.where("row_key = 'k7'")}
    got = QL.misrouted(branches)
    assert got.schema.simpleString() == "struct<row_key:string,branches:bigint,first_branch:string>"
    keys = [f"k{i}" for i in range(100)]
    taken = {k: [n for n, hit in (("a", k > "k3"), ("b", k < "k5"), ("c", k == "k7")) if hit] for k in keys}
    assert rows(got, "row_key", "branches", "first_branch") == sorted((k, len(v), v[0]) for k, v in taken.items() if len(v) > 1)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
