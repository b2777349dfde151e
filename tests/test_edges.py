"""Golden cases: hand-made resources in, exact CDM rows out."""

import base64
import datetime as dt

from helpers import coding, context, key, rows

from medloom.plans import edges as E
from medloom.plans import views as W
from medloom.schema import cdm

D, TS = dt.date, dt.datetime
PAT, ENC = {"reference": "Patient/p1"}, {"reference": "Encounter/e1"}


def condition(i, code, **more):
    base = {"resourceType": "Condition", "id": i, "subject": PAT, "encounter": ENC, "onsetDateTime": "2020-05-01"}
    return {**base, "code": code, **more}


def test_condition_routes_by_domain_and_prefers_snomed(spark):
    both = {"coding": [{"system": W.ICD10CM, "code": "I10"}, {"system": W.SNOMED, "code": "cond", "display": "Shown"}]}
    ctx = context(
        spark,
        condition("c1", both, recorder={"reference": "Practitioner/a"}),
        condition("c2", coding(W.SNOMED, "two-targets")),
        condition("c3", coding(W.SNOMED, "dead-link")),
        condition("c4", coding(W.SNOMED, "no-link")),
        condition("c5", coding("http://unknown.example", "cond")),
        condition("c6", coding(W.SNOMED, "cond"), verificationStatus={"coding": [{"code": "refuted"}]}),
        condition("c7", coding(W.SNOMED, "proc")),
    )
    got = rows(E.condition_occurrence(ctx), "condition_occurrence_id", "condition_concept_id", "condition_source_value")
    want = [(key(spark, "c1|1"), 1, "Shown"), (key(spark, "c2|1"), 1, "two-targets")]
    assert got == sorted(want, key=repr)
    assert rows(E.condition_measurement(ctx), "measurement_id") == [(key(spark, "c2|5"),)]
    assert rows(E.condition_procedure(ctx), "procedure_concept_id") == [(3,)]
    assert E.condition_observation(ctx).count() == 0


def test_condition_dates_status_and_type(spark):
    ctx = context(
        spark,
        condition(
            "c1",
            coding(W.SNOMED, "cond"),
            onsetDateTime="2020-05-01T23:30:00-05:00",
            abatementDateTime="2020-06-02T01:00:00+09:00",
            clinicalStatus={"coding": [{"code": "resolved"}]},
            verificationStatus={"coding": [{"code": "unconfirmed"}]},
            category=[{"coding": [{"code": "problem-list-item"}]}],
        ),
    )
    row = rows(E.condition_occurrence(ctx))[0]
    assert row["condition_start_date"] == D(2020, 5, 1)
    assert row["condition_start_datetime"] == TS(2020, 5, 1, 23, 30)
    assert row["condition_end_datetime"] == TS(2020, 6, 2, 1)
    assert row["condition_status_concept_id"] == 32906
    assert row["condition_type_concept_id"] == 32840


def test_procedure_priority_status_and_utc(spark):
    codes = {"coding": [{"system": W.CPT4, "code": "9999"}, {"system": W.SNOMED, "code": "proc"}]}
    head = {"resourceType": "Procedure", "subject": PAT, "encounter": ENC}
    ctx = context(
        spark,
        {**head, "id": "x1", "code": codes, "performedDateTime": "2020-01-01T23:30:00-05:00"},
        {**head, "id": "x2", "code": coding(W.CPT4, "9999"), "performedPeriod": {"start": "2020-01-01T00:30:00+02:00"}},
        {**head, "id": "x3", "code": coding(W.SNOMED, "proc"), "status": "not-done"},
        {**head, "id": "x4", "code": coding(W.SNOMED, "cond")},
    )
    got = rows(E.procedure_occurrence(ctx), "procedure_source_value", "procedure_date", "procedure_datetime")
    assert got == [
        ("9999", D(2019, 12, 31), TS(2019, 12, 31, 22, 30)),
        ("proc", D(2020, 1, 2), TS(2020, 1, 2, 4, 30)),
    ]


def test_observation_values(spark):
    head = {"resourceType": "Observation", "subject": PAT, "effectiveDateTime": "2021-01-01"}
    quantity = {"value": 120.5, "unit": "mmHg", "code": "mm[Hg]", "comparator": ">="}
    ctx = context(
        spark,
        {**head, "id": "o1", "code": coding(W.LOINC, "bp"), "valueQuantity": quantity},
        {**head, "id": "o2", "code": coding(W.LOINC, "smoke"), "valueCodeableConcept": {**coding(W.SNOMED, "yes"), "text": "Yes"}},
        {**head, "id": "o3", "code": coding(W.LOINC, "bp")},
        {**head, "id": "o4", "code": coding(W.LOINC, "smoke"), "valueString": "s" * 80},
        {**head, "id": "o5", "code": coding(W.LOINC, "bp"), "valueQuantity": quantity, "status": "cancelled"},
        {
            **head,
            "id": "o6",
            "code": coding(W.LOINC, "panel"),
            "component": [
                {"code": coding(W.LOINC, "bp"), "valueQuantity": quantity},
                {"code": coding(W.LOINC, "bp"), "valueString": "no number"},
                {"code": coding(W.LOINC, "smoke"), "valueCodeableConcept": coding(W.SNOMED, "yes")},
            ],
        },
    )
    m = rows(E.observation_measurement(ctx))
    assert len(m) == 1 and m[0]["operator_concept_id"] == 4171755 and m[0]["unit_concept_id"] == 16
    assert float(m[0]["value_as_number"]) == 120.5
    o = rows(E.observation_observation(ctx), "value_as_concept_id", "value_as_string", "value_source_value")
    assert o == sorted([(7, None, "Yes"), (None, "s" * 60, None)], key=repr)
    assert rows(E.component_measurement(ctx), "measurement_id") == [(key(spark, "o6/bp|5"),)]
    assert rows(E.component_observation(ctx), "observation_id", "value_as_concept_id") == [(key(spark, "o6/o/smoke|6"), 7)]


def test_drugs(spark):
    def med(system, code):
        return {"medicationCodeableConcept": coding(system, code), "subject": PAT}

    ctx = context(
        spark,
        {"resourceType": "MedicationRequest", "id": "r1", "authoredOn": "2020-02-03", **med(W.NDC, "ndc")},
        {"resourceType": "MedicationRequest", "id": "r2", "status": "draft", **med(W.RXNORM, "rx")},
        {"resourceType": "MedicationAdministration", "id": "a1", "effectiveDateTime": "2020-02-03", **med(W.RXNORM, "rx")},
        {
            "resourceType": "MedicationDispense",
            "id": "d1",
            "whenHandedOver": "2020-02-03",
            "quantity": {"value": 2.5},
            "daysSupply": {"value": 30},
            **med(W.RXNORM, "rx"),
        },
        {
            "resourceType": "MedicationStatement",
            "id": "s1",
            "effectivePeriod": {"start": "2020-02-03", "end": "2020-03-01"},
            **med(W.RXNORM, "rx"),
        },
        {"resourceType": "Immunization", "id": "i1", "patient": PAT, "vaccineCode": coding(W.CVX, "cvx-lone"), "occurrenceDateTime": "2020-02-03"},
        {"resourceType": "Immunization", "id": "i2", "patient": PAT, "vaccineCode": coding(W.CVX, "cvx-mapped"), "occurrenceDateTime": "2020-02-03"},
        {"resourceType": "Immunization", "id": "i3", "patient": PAT, "vaccineCode": coding(W.CVX, "nowhere"), "occurrenceDateTime": "2020-02-03"},
        {"resourceType": "Medication", "id": "m1", "code": coding(W.RXNORM, "rx")},
    )
    assert rows(E.medication_request(ctx), "drug_concept_id", "drug_source_value") == [(9, "ndc")]
    assert rows(E.medication_administration(ctx), "drug_type_concept_id") == [(38000179,)]
    dispensed = rows(E.medication_dispense(ctx))[0]
    assert float(dispensed["quantity"]) == 2.5 and dispensed["days_supply"] == 30
    assert rows(E.medication_statement(ctx), "drug_exposure_end_date") == [(D(2020, 3, 1),)]
    assert rows(E.immunization(ctx), "drug_concept_id", "drug_source_concept_id") == [(0, 11), (9, 12)]
    assert E.medication(ctx).count() == 0 and E.medication(ctx).columns == cdm.columns("drug_exposure")


def test_person_location_death(spark):
    race = {
        "url": W.US_CORE_RACE,
        "extension": [
            {"url": "ombCategory", "valueCoding": {"code": "UNK"}},
            {"url": "text", "valueString": "Other"},
        ],
    }
    native = {"url": "http://any.example/StructureDefinition/omop-race", "valueCoding": {"code": "8515", "display": "A"}}
    sex = {"url": W.US_CORE_BIRTHSEX, "valueCode": "M"}
    home = {"line": ["1 St"], "city": "Old", "state": "MA", "postalCode": "1"}
    official = {"use": "official", "city": "New", "country": "US"}
    ctx = context(
        spark,
        {"resourceType": "Patient", "id": "p1", "gender": "female", "birthDate": "1980-02-03", "extension": [race, sex], "address": [home, official]},
        {"resourceType": "Patient", "id": "p2", "birthDate": "1980-02-03", "extension": [race, native], "address": [home]},
        {"resourceType": "Patient", "id": "p3", "address": [home], "deceasedDateTime": "2020-01-01T22:00:00-05:00"},
        {"resourceType": "Patient", "id": "p4", "deceasedBoolean": True},
    )
    got = {r["person_source_value"]: r for r in rows(E.person(ctx))}
    assert got["p1"]["gender_concept_id"] == 8507 and got["p1"]["gender_source_concept_id"] == 21
    assert got["p1"]["race_concept_id"] == 8522 and got["p2"]["race_concept_id"] == 8515
    assert got["p4"]["race_concept_id"] == 0 and "location_id" not in got["p4"]
    assert got["p1"]["location_id"] == key(spark, "New")
    assert got["p2"]["location_id"] == key(spark, "1 St|Old|MA|1")
    places = rows(E.patient_location(ctx), "location_id", "country_concept_id", "location_source_value")
    assert places == sorted([(key(spark, "New"), 4330442, "New"), (key(spark, "1 St|Old|MA|1"), 0, "1 St, Old, MA, 1")], key=repr)
    assert rows(E.death(ctx), "death_date") == [(D(2020, 1, 1),)]


def test_two_visits_make_one_period(spark):
    head = {"resourceType": "Encounter", "subject": PAT, "class": {"code": "IMP"}}
    ctx = context(
        spark,
        {"resourceType": "Patient", "id": "p1"},
        {"resourceType": "Patient", "id": "lonely"},
        {**head, "id": "e1", "period": {"start": "2020-01-01T20:00:00-05:00", "end": "2020-01-05T00:00:00Z"}},
        {**head, "id": "e2", "period": {"start": "2020-03-01T00:00:00Z"}},
        {**head, "id": "e3", "status": "cancelled", "period": {"start": "2030-03-01T00:00:00Z"}},
    )
    period = rows(E.observation_period(ctx))
    assert len(period) == 1 and period[0]["observation_period_start_date"] == D(2020, 1, 2)
    assert period[0]["observation_period_end_date"] == D(2020, 3, 1)


def test_provider_roles_device_specimen_note_coverage(spark):
    text = "Grüße ✓"
    ctx = context(
        spark,
        {"resourceType": "Practitioner", "id": "a", "name": [{"family": "F", "given": ["G"]}], "gender": "Female"},
        {"resourceType": "PractitionerRole", "id": "r", "practitioner": {"reference": "Practitioner/a"}, "organization": {"reference": "Organization/g"}, "specialty": [coding(W.SNOMED, "specialist")]},
        {"resourceType": "PractitionerRole", "id": "r2", "practitioner": {"reference": "Practitioner/a"}},
        {"resourceType": "Device", "id": "d1", "status": "active", "patient": PAT, "type": coding(W.SNOMED, "device"), "manufactureDate": "2020-01-01"},
        {"resourceType": "Device", "id": "d2", "status": "entered-in-error", "patient": PAT, "type": coding(W.SNOMED, "device")},
        {"resourceType": "Specimen", "id": "s1", "subject": PAT, "type": coding(W.SNOMED, "blood"), "collection": {"collectedDateTime": "2020-01-01", "bodySite": coding(W.SNOMED, "arm")}},
        {"resourceType": "DiagnosticReport", "id": "n1", "subject": PAT, "effectiveDateTime": "2020-01-01", "code": {**coding(W.LOINC, "note"), "text": "T"}, "presentedForm": [{"data": base64.b64encode(text.encode()).decode()}]},
        {"resourceType": "Coverage", "id": "v1", "beneficiary": PAT, "period": {"end": "2020-12-31"}},
        {"resourceType": "Coverage", "id": "v2", "beneficiary": PAT},
    )
    provider = rows(E.provider_with_roles(ctx))
    assert len(provider) == 1 and provider[0]["specialty_concept_id"] == 20
    assert provider[0]["care_site_id"] == key(spark, "g") and provider[0]["gender_concept_id"] == 8532
    assert rows(E.device_exposure(ctx), "device_concept_id") == [(13,)]
    assert rows(E.specimen(ctx), "specimen_concept_id", "anatomic_site_concept_id") == [(14, 15)]
    assert rows(E.report_note(ctx), "note_text", "note_class_concept_id") == [(text, 22)]
    assert rows(E.payer_plan_period(ctx), "payer_plan_period_start_date") == [(D(2020, 12, 31),)]
