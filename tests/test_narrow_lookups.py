"""Beyond the broadcast limit rows and columns that no reader takes are neither written nor shuffled."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from medloom import session as S
from medloom.operators import joins
from medloom.operators import terminology as V

DATA = "/root/testdata/sf0.001"


@pytest.fixture(params=["500000", "0"])
def limit(spark, request):
    spark.conf.set(S.BROADCAST_ROWS_CONF, request.param)
    yield request.param
    spark.conf.unset(S.BROADCAST_ROWS_CONF)


@pytest.fixture()
def large(spark):
    spark.conf.set(S.BROADCAST_ROWS_CONF, "0")
    yield
    spark.conf.unset(S.BROADCAST_ROWS_CONF)


@pytest.fixture()
def kept(monkeypatch):
    """The tables that lookups write."""
    tables, write = [], S.written

    def written(df):
        tables.append(write(df))
        return tables[-1]

    monkeypatch.setattr(S, "written", written)
    return tables


@pytest.mark.parametrize("n", [0, 1, 700])
def test_bitmap_keeps_all_that_match(spark, n):
    left = spark.range(20000).selectExpr("id", "IF(id % 7 = 0, NULL, concat('k', id)) AS k", "CAST(id % 50 AS INT) AS v")
    right = S.written(spark.range(n).selectExpr("concat('k', id * 3) AS k", "CAST(id * 3 % 50 AS INT) AS v", "id AS w"))
    got = joins.may_match(left, right, ["k", "v"])
    assert got.columns == left.columns
    want = rows(left.join(right, ["k", "v"], "left_semi").select(*left.columns), *left.columns)
    assert rows(got.join(right, ["k", "v"], "left_semi").select(*left.columns), *left.columns) == want
    assert got.count() <= len(want) + 20000 / 8


def test_bitmap_leaves_other_types(spark):
    left = spark.range(50).select(F.col("id").cast("double").alias("k"))
    assert joins.may_match(left, S.written(spark.range(3).select(F.col("id").cast("double").alias("k"))), ["k"]).count() == 50
    assert joins.may_match(left, S.written(spark.range(3).select(F.col("id").alias("k"))), ["k"]).count() == 50


def _family(spark):
    concept = spark.range(60).selectExpr(
        "CAST(id AS INT) AS concept_id", "'n' AS concept_name", "element_at(array('A', 'B', 'C'), CAST(id % 3 AS INT) + 1) AS domain_id",
        "IF(id < 30, 'X', 'Y') AS vocabulary_id", "IF(id % 2 = 0, 'S', NULL) AS standard_concept", "concat('c', id % 30) AS concept_code",
    )
    links = spark.range(180).selectExpr(
        "CAST(id % 60 AS INT) AS concept_id_1", "CAST((id * 7 + id DIV 60) % 60 AS INT) AS concept_id_2", "'Maps to' AS relationship_id",
        "CAST(NULL AS STRING) AS invalid_reason",
    )
    systems = spark.createDataFrame([("x", "X"), ("y", "Y")], "source_code string, target_code string")
    codings = spark.range(400).selectExpr(
        "concat('r', id % 90) AS id", "IF(id % 5 < 2, 'x', 'y') AS s", "concat('c', id * 10 % 33) AS c",
        "IF(id % 4 = 0, NULL, concat('t', id % 3)) AS t", "id % 13 AS more",
    )
    return codings, V.Vocabulary(concept, links), systems


def test_domain_and_columns_give_the_rows_of_the_whole(spark, limit):
    codings, vocabulary, systems = _family(spark)

    def resolved(**some):
        return V.resolve_codings(codings, vocabulary, systems, "s", "c", ["id"], ["y"], ["t"], **some)

    whole = resolved()
    assert "more" in whole.columns and whole.count() > 100
    shown = ["id", "c", "t", "src_concept_id", "std_concept_id", "std_domain"]
    for domain in ("A", "B", "C", "none"):
        assert rows(resolved(domain=domain), *shown) == rows(V.route(whole, domain), *shown)
    assert rows(resolved(columns=["id", "t"]), *shown) == rows(whole, *shown)
    few = ["id", "src_concept_id", "std_concept_id", "std_domain"]
    assert rows(resolved(columns=["id"]), *few) == rows(whole, *few)
    assert rows(resolved(columns=[], domain="B"), *few) == rows(V.route(whole, "B"), *few)


def test_edge_writes_codings_of_its_domain_only(spark, large, kept):
    from __spark_entry__ import queries
    from checks import mirror

    mirror._seen.clear()
    for name in ("edge_condition_measurement", "edge_report_measurement"):
        kept.clear()
        queries()[name](spark, DATA)
        codings = next(t for t in kept if "subject_ref" in t.columns)
        assert codings.count() < 12_000 / 3  # 6,000 resources of two codings
    mirror._seen.clear()


@pytest.mark.parametrize("name", ["resolve_condition", "route_domains", "unrouted_rows", "family_route_counts", "family_routes_disjoint"])
def test_family_queries_write_their_columns_only(spark, large, kept, name):
    from __spark_entry__ import queries
    from checks import mirror

    mirror._seen.clear()
    queries()[name](spark, DATA)
    assert kept and all("subject_ref" not in t.columns and "abatement_string" not in t.columns for t in kept)
    mirror._seen.clear()
