import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from medloom.operators import quality as QL
from medloom.operators import references as R
from medloom.operators.flatten import flatten
from medloom.plans import views
from medloom.plans.csv_cdm import cdm_source
from medloom.sources import clinical_csv, conceptmaps, fhir, vocabulary
from medloom.streaming import ingest


def bundle(*resources):
    return json.dumps({"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]})


def patient(i, **more):
    return {"resourceType": "Patient", "id": i, **more}


def test_bundles_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(bundle(patient("p1", gender="male"), patient("p1", gender="female"), {"id": "x"}))
    (tmp_path / "b.json").write_text(json.dumps(patient("p2")))
    (tmp_path / "c.json").write_text('{"resourceType": "Bundle", "entry": [')
    rows = fhir.entries(fhir.read_files(spark, str(tmp_path))).cache()
    counts = {r.resource_type: (r.inserted, r.skipped, r.broken_files) for r in fhir.load_counts(rows).collect()}
    assert counts == {"Patient": (3, 0, 0), None: (0, 1, 1)}
    got = {r.id: json.loads(r.resource) for r in fhir.load(spark, str(tmp_path)).collect()}
    assert got["p1"]["gender"] == "female" and set(got) == {"p1", "p2"}
    fhir.write_raw(fhir.load(spark, str(tmp_path)), str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted(r.resource_type for r in back.collect()) == ["Patient", "Patient"]
    # An edge opens only the folder of its own type, and only the JSON column.
    plan = flatten(back, views.patient_death)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(resource_type" in plan and "ReadSchema: struct<resource:string>" in plan


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"resourceType":"A","id":"1","v":12345678901234567890.5}', [("A", "1", False)]),
        ('{"resourceType":"A","id":7}', [("A", "7", False)]),
        ('{"resourceType":"A","id":""}', [("A", None, False)]),
        ('{"resourceType":"A","id":"1","id":"2"}', [("A", "2", False)]),
        ('{"resourceType":"Bundle"}', []),
        ('{"resourceType":"Bundle","entry":null}', []),
        ('{"resourceType":"Bundle","entry":[{"fullUrl":"u"},{"resource":null},{"resource":{"id":"1"}}]}', [(None, None, False)] * 2 + [(None, "1", False)]),
        ('{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"A","id":"1","x":1,"x":2}}]}', [("A", "1", False)]),
        ('{"resourceType":"Bundle","entry":5}', [(None, None, True)]),
        ('[{"resourceType":"A","id":"1"}]', [(None, None, False)]),
        ('{"resourceType":"A","id":"1"} behind', [(None, None, True)]),
        ('{"resourceType":"A","id":"1"}] behind', [(None, None, True)]),
        ('{"resourceType":"A","id":"1"}\n{"resourceType":"A","id":"2"}', [(None, None, True)]),
        ("", [(None, None, True)]),
        (" ", [(None, None, True)]),
        (None, [(None, None, True)]),
    ],
)
def test_entries_of_one_text(spark, text, want):
    rows = fhir.entries(spark.createDataFrame([(text, "keep")], "value string, position_in_run string")).orderBy("position").collect()
    assert [(r.resource_type, r.id, r.broken) for r in rows] == want
    assert all(r.position_in_run == "keep" for r in rows)
    if text and "12345678901234567890.5" in text:
        assert "12345678901234567890.5" in rows[0].resource


def test_line_exports_are_split_and_the_last_line_wins(spark, tmp_path):
    lines = [json.dumps(patient(f"p{i % 500}", gender=str(i))) for i in range(4000)]
    lines[3000:3000] = ["", "{broken", bundle(patient("inside", gender="x"), patient("inside", gender="y"))]
    (tmp_path / "a.ndjson").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = fhir.read_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 3
        assert fhir.load_counts(fhir.entries(read)).where("broken_files > 0").first().broken_files == 1
        got = {r.id: json.loads(r.resource)["gender"] for r in fhir.load(spark, str(tmp_path), lines=True).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {**{f"p{i % 500}": str(i) for i in range(3500, 4000)}, "inside": "y"}


@pytest.mark.parametrize(
    ("name", "table"),
    [("Patient", "patient"), ("MedicationRequest", "medication_request"), ("DiagnosticReport", "diagnostic_report")],
)
def test_table_names(spark, name, table):
    assert spark.range(1).select(fhir.table_name(F.lit(name))).first()[0] == table


def test_stream_appends_and_snapshot_takes_the_latest(spark, tmp_path):
    source, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    source.mkdir()
    (source / "a.json").write_text(bundle(patient("p1", gender="male")))
    ingest.start(spark, str(source), log, state).awaitTermination()
    later = source / "b.json"
    later.write_text(bundle(patient("p1", gender="other"), patient("p2")))
    ingest.start(spark, str(source), log, state).awaitTermination()
    assert spark.read.parquet(log).count() == 3
    got = {r.id: json.loads(r.resource).get("gender") for r in ingest.snapshot(spark, log).collect()}
    assert got == {"p1": "other", "p2": None}


def test_vocabulary_bundle(spark, tmp_path):
    head = "concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\t"
    head += "valid_start_date\tvalid_end_date\tinvalid_reason\n"
    (tmp_path / "CONCEPT.csv").write_text(
        head + '1\tA "quoted name\tDrug\tRxNorm\tIngredient\tS\t77\t19700101\t20991231\t\n'
        "2\tB\tDrug\tRxNorm\tIngredient\t\t78\t19700101\t20991231\tD\n"
    )
    got = vocabulary.read_bundle(spark, str(tmp_path))
    assert set(got) == {"concept"}
    first = got["concept"].orderBy("concept_id").first()
    assert first.concept_name == 'A "quoted name' and first.valid_end_date == dt.date(2099, 12, 31)
    assert first.invalid_reason is None and first.concept_id == 1
    vocabulary.write_bundle(got, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/concept")).count() == 2


def test_cvx(spark, tmp_path):
    (tmp_path / "cvx.txt").write_text(
        "08|short|Hep B|note|Active|f|2010/05/28\n\nabc|x|y|z|Active|f|\n09|s|Td|n|Inactive|f|\nfew|fields\n"
    )
    rows = vocabulary.read_cvx(spark, str(tmp_path / "cvx.txt"), dt.date(2024, 1, 2)).orderBy("concept_id").collect()
    assert [(r.concept_id, r.concept_code, r.invalid_reason) for r in rows] == [
        (2_000_000_000, "08", None),
        (2_000_000_001, "09", "D"),
    ]
    assert rows[1].valid_start_date == dt.date(2000, 1, 1) and rows[1].valid_end_date == dt.date(2024, 1, 2)


def test_concept_maps(spark):
    maps = conceptmaps.build_all(spark)
    assert len(maps) == 10
    for rows in maps.values():
        conceptmaps.require_unique(rows, "source_code")
    double = {"code": "a", "target": [{"code": "5"}, {"code": "6"}]}
    text = json.dumps({"resourceType": "ConceptMap", "id": "my-map", "group": [{"element": [double, {"code": "b"}]}] * 2})
    rows = conceptmaps.from_resources(spark.createDataFrame([(text,)], "value string"))
    assert rows.first().map_id == "my_map" and rows.first().concept_id == 5
    with pytest.raises(ValueError, match="duplicate"):
        conceptmaps.require_unique(rows, "map_id", "source_code")


def test_csv_tables_are_typed_by_name(spark, tmp_path):
    (tmp_path / "encounters.csv").write_text("Id,START,STOP,BASE_ENCOUNTER_COST,CODE\n1,2020-01-02T03:04:05Z,,12.50,007\n")
    row = clinical_csv.read_table(spark, str(tmp_path), "encounters").first()
    assert row.start == dt.date(2020, 1, 2) and row.stop is None and float(row.base_encounter_cost) == 12.5
    assert row.code == "007" and clinical_csv.states(spark).count() == 51


def test_search_references_are_idempotent(spark):
    system = "http://hl7.org/fhir/sid/us-npi"
    people = [{"resourceType": "Practitioner", "id": i, "identifier": [{"system": system, "value": "9"}]} for i in ("b", "a")]
    seeks = {
        "resourceType": "Encounter",
        "id": "e",
        "participant": [{"individual": {"reference": f"Practitioner?identifier={system}|9", "display": "x"}}],
        "serviceProvider": {"reference": "Organization?identifier=none|1"},
    }
    rows = [(r["resourceType"], r["id"], json.dumps(r)) for r in [*people, seeks]]
    raw = spark.createDataFrame(rows, "resource_type string, id string, resource string")
    index = R.identifier_index(raw)
    assert R.duplicate_identifiers(index).count() == 1
    once = R.resolve_references(raw, index)
    text = json.loads(once.where("id = 'e'").first().resource)
    assert text["participant"][0]["individual"]["reference"] == "Practitioner/a"
    assert text["serviceProvider"]["reference"].startswith("Organization?")
    assert sorted(map(tuple, R.resolve_references(once, index).collect())) == sorted(map(tuple, once.collect()))


def test_required_elements(spark):
    def passes(resource, paths):
        df = spark.createDataFrame([(json.dumps(resource),)], "resource string")
        return QL.required_elements(df, paths).count() == 1

    assert passes({}, [])
    assert passes({"onsetPeriod": {}}, ["onset[x]"]) and not passes({"on": 1}, ["onset[x]"])
    assert passes({"period": {"start": "2020"}}, ["period.start"]) and not passes({"period": {}}, ["period.start"])
    assert passes({"code": None}, ["code"])
    assert not passes({"specialty": [{"coding": []}]}, ["specialty.coding"])


def test_cdm_source(spark):
    table = spark.createDataFrame([("None", "v5.0 X"), ("SNOMED", "y")], "vocabulary_id string, vocabulary_version string")
    row = cdm_source(table, cdm_source_name="n", cdm_source_abbreviation="a", cdm_holder="h").collect()
    assert len(row) == 1 and row[0].vocabulary_version == "v5.0 X" and row[0].cdm_version_concept_id == 756265
