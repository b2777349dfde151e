"""Beyond the broadcast limit rows are computed once, however often a lookup reads them."""

import pytest
from pyspark.sql import functions as F

from medloom import session as S
from medloom.operators import joins
from medloom.operators import terminology as V


@pytest.fixture(params=["5", "0"])
def large(spark, request):
    spark.conf.set(S.BROADCAST_ROWS_CONF, request.param)
    yield
    spark.conf.unset(S.BROADCAST_ROWS_CONF)


def counted(spark, n=60):
    """Rows whose making is counted, and the counter."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return spark.range(n).mapInArrow(run, "id long"), made


def test_lookup_computes_rows_once(spark, large):
    rows, made = counted(spark)
    rows = rows.withColumn("k", F.when(F.col("id") % 4 != 0, F.col("id") % 20))
    lookup = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = joins.lookup_join(rows, lookup, ["k"], "left")
    assert {r["id"]: r["v"] for r in got.collect()} == {i: i % 20 * 10 if i % 4 else None for i in range(60)}
    assert made.value == 60


def test_priority_computes_rows_once(spark, large):
    rows, made = counted(spark)
    rows = rows.select("id", *[F.when(F.col("id") % d == 0, F.concat(F.lit(n), F.col("id"))).alias(n) for n, d in (("a", 2), ("b", 3))])
    day = "DATE '2000-01-01'"
    concept = spark.range(120).selectExpr(
        "CAST(id AS INT) AS concept_id", "'n' AS concept_name", "'Drug' AS domain_id", "IF(id < 60, 'A', 'B') AS vocabulary_id",
        "'S' AS standard_concept", "concat(IF(id < 60, 'a', 'b'), id % 60) AS concept_code",
    )
    links = spark.range(120).selectExpr(
        "CAST(id AS INT) AS concept_id_1", "CAST(id AS INT) AS concept_id_2", "'Maps to' AS relationship_id",
        "CAST(NULL AS STRING) AS invalid_reason", f"{day} AS valid_start_date",
    )
    vocabulary = V.Vocabulary(concept, links)
    assert not vocabulary.small
    got = V.resolve_priority(rows, vocabulary, [("A", "a"), ("B", "b")], "Drug").collect()
    want = {i: i if i % 2 == 0 else i + 60 for i in range(60) if i % 2 == 0 or i % 3 == 0}
    assert {r["id"]: r["std_concept_id"] for r in got} == want and len(got) == len(want)
    assert made.value == 60
