"""Hand-made vocabulary and resources for the golden tests."""

from __future__ import annotations

import json

from medloom.functions.keys import string_id
from medloom.operators.terminology import Vocabulary
from medloom.plans.edges import Context

CONCEPT = (
    "concept_id int, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, "
    "standard_concept string, concept_code string, valid_start_date date, valid_end_date date, invalid_reason string"
)
LINK = "concept_id_1 int, concept_id_2 int, relationship_id string, invalid_reason string"

# id, domain, vocabulary, standard, code
CONCEPTS = [
    (1, "Condition", "SNOMED", "S", "cond"),
    (2, "Condition", "ICD10CM", None, "I10"),
    (3, "Procedure", "SNOMED", "S", "proc"),
    (4, "Procedure", "CPT4", None, "9999"),
    (5, "Measurement", "LOINC", "S", "bp"),
    (6, "Observation", "LOINC", "S", "smoke"),
    (7, "Meas Value", "SNOMED", "S", "yes"),
    (8, "Observation", "SNOMED", "S", "also"),
    (9, "Drug", "RxNorm", "S", "rx"),
    (10, "Drug", "NDC", None, "ndc"),
    (11, "Drug", "CVX", None, "cvx-lone"),
    (12, "Drug", "CVX", None, "cvx-mapped"),
    (13, "Device", "SNOMED", "S", "device"),
    (14, "Specimen", "SNOMED", "S", "blood"),
    (15, "Spec Anatomic Site", "SNOMED", "S", "arm"),
    (16, "Unit", "UCUM", "S", "mm[Hg]"),
    (17, "Condition", "SNOMED", None, "two-targets"),
    (18, "Condition", "SNOMED", None, "dead-link"),
    (19, "Condition", "SNOMED", None, "no-link"),
    (20, "Provider", "SNOMED", "S", "specialist"),
    (21, "Gender", "Gender", "S", "M"),
    (22, "Note", "LOINC", "S", "note"),
]
LINKS = [
    *[(i, i, "Maps to", None) for i in (1, 3, 5, 6, 7, 8, 9, 13, 14, 15, 16, 20, 22)],
    (2, 1, "Maps to", None),
    (4, 3, "Maps to", None),
    (10, 9, "Maps to", None),
    (12, 9, "Maps to", None),
    (17, 1, "Maps to", None),
    (17, 5, "Maps to", None),
    (18, 1, "Maps to", "D"),
    (2, 3, "Is a", None),
]


def vocabulary(spark) -> Vocabulary:
    rows = [(i, f"name {i}", d, v, "class", s, c, None, None, None) for i, d, v, s, c in CONCEPTS]
    return Vocabulary(spark.createDataFrame(rows, CONCEPT), spark.createDataFrame(LINKS, LINK))


def context(spark, *resources: dict) -> Context:
    rows = [(r["resourceType"], r.get("id", "none"), json.dumps(r)) for r in resources]
    return Context(spark.createDataFrame(rows, "resource_type string, id string, resource string"), vocabulary(spark))


def key(spark, text: str) -> int:
    return spark.range(1).select(string_id(__import__("pyspark").sql.functions.lit(text))).first()[0]


def rows(df, *columns):
    """Rows as sorted tuples; no columns means all non-NULL ones as dicts."""
    if columns:
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in df.collect()]


def coding(system: str, code: str, **more) -> dict:
    return {"coding": [{"system": system, "code": code, **more}]}
