"""Source rows that no event asks costs for are left out before they are joined; stored tables are packed."""

import os

from pyspark.sql import functions as F

from medloom import session as S
from medloom.plans import csv_cdm as P

DATA = "/root/testdata/sf0.001"


def test_claims_are_cut_to_asked_keys(spark, monkeypatch):
    from __spark_entry__ import queries
    from checks import mirror

    kept, write = [], S.written

    def written(df):
        kept.append(write(df))
        return kept[-1]

    monkeypatch.setattr(S, "written", written)
    monkeypatch.setattr(P.S, "written", written)
    mirror._seen.clear()
    rows = queries()["csv_cost"](spark, DATA)
    mirror._seen.clear()
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    claims = next(t for t in kept if "claimid" in t.columns)
    assert 0 < claims.count() < lines / 3
    assert rows.where("cost_domain_id = 'Condition'").count() > 0


def test_cut_lineage_takes_a_packed_table(spark):
    df = spark.range(20000).select(F.concat(F.lit("Patient/p"), F.col("id")).alias("ref"), F.lit("final").alias("status"))
    cut = S.checkpointed(df)
    assert cut.count() == 20000 and "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()
    files = [f.removeprefix("file:") for f in cut.inputFiles()]
    assert files and sum(os.path.getsize(f) for f in files) < 200_000
