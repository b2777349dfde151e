from helpers import coding, context
from pyspark.sql import functions as F

from medloom.operators import quality as QL
from medloom.plans import plan
from medloom.plans import views as W
from medloom.schema import cdm

PAT = {"reference": "Patient/p1"}


def resources():
    head = {"subject": PAT, "effectiveDateTime": "2020-01-01"}
    return [
        {"resourceType": "Patient", "id": "p1", "gender": "male", "birthDate": "1980-01-01"},
        {"resourceType": "Patient", "id": "p2"},
        {"resourceType": "Encounter", "id": "e1", "status": "finished", "class": {"code": "AMB"}, "subject": PAT, "period": {"start": "2020-01-01T00:00:00Z"}},
        {"resourceType": "Practitioner", "id": "a", "gender": "male", "identifier": [{"value": "1"}], "name": [{"family": "F"}]},
        {"resourceType": "PractitionerRole", "id": "r", "practitioner": {"reference": "Practitioner/a"}, "specialty": [coding(W.SNOMED, "specialist")]},
        {"resourceType": "Condition", "id": "c1", "subject": PAT, "code": coding(W.SNOMED, "cond"), "onsetDateTime": "2020-01-01"},
        {"resourceType": "Condition", "id": "c2", "subject": PAT, "code": coding(W.SNOMED, "cond")},
        {"resourceType": "Observation", "id": "o1", "code": coding(W.LOINC, "bp"), "valueString": "x", **head},
        {"resourceType": "DiagnosticReport", "id": "d1", "code": coding(W.LOINC, "bp"), **head},
    ]


def test_run_edge_is_lazy_and_conforms(spark):
    ctx = context(spark, *resources())
    for name, edge in plan.BY_NAME.items():
        got = [(f.name, f.dataType) for f in plan.run_edge(ctx, name).schema]
        assert got == [(f.name, f.dataType) for f in cdm.schema(edge.target)], name
    assert len(plan.PLAN) == 32


def test_write_tables(spark, tmp_path):
    report = plan.write_tables(context(spark, *resources()), str(tmp_path / "out"))
    assert {r.table: r.duplicate_keys for r in report.collect()} == dict.fromkeys({e.target for e in plan.PLAN}, 0)
    read = lambda t: spark.read.parquet(str(tmp_path / "out" / t))
    assert read("measurement").count() == 2
    assert read("condition_occurrence").count() == 1
    bad = read("_quarantine/condition_occurrence").collect()
    assert [r.missing for r in bad] == [["condition_start_date"]]
    assert read("provider").first().specialty_concept_id == 20
    assert "missing" not in read("condition_occurrence").columns
    profile = {(r.table, r.column): r for r in read("_profile").collect()}
    assert profile["condition_occurrence", "condition_start_date"].nulls == 1
    assert profile["condition_occurrence", "condition_occurrence_id"].rows == 2
    assert [r.missing for r in read("_quarantine/person").collect()] == [["year_of_birth"]]


def test_a_table_is_computed_once_and_profiled(spark, tmp_path):
    out, calls = str(tmp_path / "out"), spark.sparkContext.accumulator(0)
    death = plan.run_edge(context(spark, *resources()), "Patient__death")
    names = cdm.primary_key("death"), cdm.REQUIRED["death"]
    assert names[0] in death.columns
    seen = spark.range(50).select(
        *[
            (F.when(F.col("id") % 10 != i, F.lit("2020-01-01" if "date" in f.name else 7 * i + 1).cast(f.dataType)) if f.name in [names[0], *names[1]] else F.lit(None).cast(f.dataType)).alias(f.name)
            for i, f in enumerate(death.schema.fields)
        ]
    )

    def counting(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    counted = seen.mapInArrow(counting, seen.schema)
    rows = spark.createDataFrame(plan.write_table(counted, "death", out), QL.PROFILE_SCHEMA)
    assert calls.value == 50
    kept, bad = spark.read.parquet(f"{out}/death"), spark.read.parquet(f"{out}/_quarantine/death")
    assert kept.columns == death.columns and kept.count() + bad.count() == 50 and 0 < bad.count() < 50
    good, wrong = QL.split_required(seen, "death")
    assert QL.row_bag_difference(kept, good).isEmpty() and QL.row_bag_difference(bad, wrong).isEmpty()
    key = cdm.primary_key("death")
    same = QL.null_profile(seen, [c for c in seen.columns if c != key], key)
    columns = ["column", "rows", "nulls", "null_rate", "violation"]
    assert {tuple(r) for r in rows.select(*columns).collect()} == {tuple(r) for r in same.select(*columns).collect()}
    n = bad.count()
    # only bad rows in a second run: the table is empty, not the older one
    plan.write_table(wrong.drop("missing"), "death", out)
    assert spark.read.parquet(f"{out}/death").count() == 0 and spark.read.parquet(f"{out}/_quarantine/death").count() == n


def test_strict_gate_drops_incomplete_resources(spark, tmp_path):
    plan.write_tables(context(spark, *resources()), str(tmp_path / "out"), strict=True)
    assert spark.read.parquet(str(tmp_path / "out/person")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/_quarantine/condition_occurrence")).count() == 0
    assert spark.read.parquet(str(tmp_path / "out/provider")).first().specialty_concept_id == 38004446
