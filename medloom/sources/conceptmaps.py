"""Concept maps: small code-to-concept tables, built in or read from ConceptMap resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAP_SCHEMA = (
    "source_code string, concept_id int, source_concept_id int, target_code string, "
    "source_display string, target_display string, equivalence string"
)

# Map id -> groups of (source vocabulary or None, rows of
# (source code, source display, target code, target display, equivalence)).
_ACT_CLASSES = [
    ("AMB", "ambulatory", "9202", "Outpatient Visit", "equivalent"),
    ("IMP", "inpatient", "9201", "Inpatient Visit", "equivalent"),
    ("ACUTE", "acute inpatient", "9201", "Inpatient Visit", "wider"),
    ("NONAC", "non-acute", "42898160", "Non-hospital institution Visit", "wider"),
    ("EMER", "emergency", "9203", "Emergency Room Visit", "equivalent"),
    ("SS", "short stay", "8870", "Emergency Room - Hospital", "wider"),
    ("HH", "home health", "581476", "Home Visit", "equivalent"),
    ("FLD", "field", "581476", "Home Visit", "wider"),
    ("OBSENC", "observation enc", "9202", "Outpatient Visit", "wider"),
    ("VR", "virtual", "722455", "Telehealth", "equivalent"),
    ("PRENC", "pre-admission", "9202", "Outpatient Visit", "wider"),
]
_PLAIN_CLASSES = [
    ("ambulatory", "ambulatory", "9202", "Outpatient Visit", "equivalent"),
    ("outpatient", "outpatient", "9202", "Outpatient Visit", "equivalent"),
    ("wellness", "wellness", "9202", "Outpatient Visit", "wider"),
    ("inpatient", "inpatient", "9201", "Inpatient Visit", "equivalent"),
    ("emergency", "emergency", "9203", "Emergency Room Visit", "equivalent"),
    ("urgentcare", "urgent care", "8870", "Emergency Room - Hospital", "wider"),
    ("hospice", "hospice", "8546", "Hospice", "equivalent"),
    ("snf", "SNF", "8676", "Nursing Facility", "wider"),
    ("virtual", "virtual", "722455", "Telehealth", "equivalent"),
]
_NONE = ("0", "No matching concept", "unmatched")
BUILT_IN: dict[str, list[tuple[str | None, list[tuple]]]] = {
    "gender": [
        (
            None,
            [
                ("male", "Male", "8507", "MALE", "equivalent"),
                ("female", "Female", "8532", "FEMALE", "equivalent"),
                ("other", "Other", "8521", "OTHER", "equivalent"),
                ("unknown", "Unknown", "8551", "UNKNOWN", "equivalent"),
            ],
        ),
        (
            "Gender",
            [
                ("M", "Male", "8507", "MALE", "equivalent"),
                ("F", "Female", "8532", "FEMALE", "equivalent"),
                ("OTH", "Other", "8521", "OTHER", "equivalent"),
                ("UNK", "Unknown", "8551", "UNKNOWN", "equivalent"),
            ],
        ),
    ],
    "race_category": [
        (
            None,
            [
                ("2106-3", "White", "8527", "White", "equivalent"),
                ("2054-5", "Black or African American", "8516", "Black or African American", "equivalent"),
                ("2028-9", "Asian", "8515", "Asian", "equivalent"),
                ("1002-5", "American Indian or Alaska Native", "8657", "American Indian or Alaska Native", "equivalent"),
                (
                    "2076-8",
                    "Native Hawaiian or Other Pacific Islander",
                    "8557",
                    "Native Hawaiian or Other Pacific Islander",
                    "equivalent",
                ),
                ("UNK", "Unknown", "8552", "Unknown", "equivalent"),
            ],
        )
    ],
    "race_text": [
        (
            None,
            [
                ("Other", "Other", "8522", "Other Race", "equivalent"),
                ("Unknown", "Unknown", "8552", "No matching concept", "equivalent"),
            ],
        )
    ],
    "ethnicity_category": [
        (
            None,
            [
                ("2135-2", "Hispanic or Latino", "38003563", "Hispanic or Latino", "equivalent"),
                ("2186-5", "Not Hispanic or Latino", "38003564", "Not Hispanic or Latino", "equivalent"),
            ],
        )
    ],
    "encounter_class": [(None, _ACT_CLASSES), (None, _PLAIN_CLASSES)],
    "clinical_status": [
        (
            None,
            [
                ("active", "Active", *_NONE),
                ("recurrence", "Recurrence", *_NONE),
                ("relapse", "Relapse", *_NONE),
                ("inactive", "Inactive", *_NONE),
                ("remission", "Remission", *_NONE),
                ("resolved", "Resolved", "32906", "Resolved condition", "equivalent"),
            ],
        )
    ],
    "verification_status": [
        (
            None,
            [
                ("unconfirmed", "Unconfirmed", *_NONE),
                ("provisional", "Provisional", "32899", "Preliminary diagnosis", "wider"),
                ("differential", "Differential", *_NONE),
                ("confirmed", "Confirmed", "32893", "Confirmed diagnosis", "equivalent"),
                ("refuted", "Refuted", *_NONE),
                ("entered-in-error", "Entered in error", *_NONE),
            ],
        )
    ],
    "condition_category": [
        (
            None,
            [
                ("encounter-diagnosis", "Encounter Diagnosis", "32827", "EHR encounter record", "equivalent"),
                ("problem-list-item", "Problem List Item", "32840", "EHR problem list", "equivalent"),
                ("health-concern", "Health Concern", "32817", "EHR", "wider"),
            ],
        )
    ],
    "country": [
        (
            None,
            [
                ("US", "United States of America", "4330442", "United States of America", "equivalent"),
                ("CA", "Canada", "4330427", "Canada", "equivalent"),
                ("GB", "United Kingdom", "4330437", "United Kingdom", "equivalent"),
                ("DE", "Germany", "4330439", "Germany", "equivalent"),
                ("AU", "Australia", "4330448", "Australia", "equivalent"),
            ],
        )
    ],
    "system_vocabulary": [
        (
            None,
            [
                ("http://snomed.info/sct", "SNOMED CT", "SNOMED", None, None),
                ("http://loinc.org", "LOINC", "LOINC", None, None),
                ("http://www.nlm.nih.gov/research/umls/rxnorm", "RxNorm", "RxNorm", None, None),
                ("http://hl7.org/fhir/sid/icd-10-cm", "ICD-10-CM", "ICD10CM", None, None),
                ("http://hl7.org/fhir/sid/icd-9-cm", "ICD-9-CM", "ICD9CM", None, None),
                ("http://hl7.org/fhir/sid/icd-10", "ICD-10", "ICD10", None, None),
                ("http://hl7.org/fhir/sid/icd-10-pcs", "ICD-10-PCS", "ICD10PCS", None, None),
                ("http://hl7.org/fhir/sid/ndc", "NDC", "NDC", None, None),
                ("http://hl7.org/fhir/sid/cvx", "CVX", "CVX", None, None),
                ("http://www.ama-assn.org/go/cpt", "CPT-4", "CPT4", None, None),
                (
                    "https://www.cms.gov/Medicare/Coding/place-of-service-codes",
                    "CMS Place of Service",
                    "CMS Place of Service",
                    None,
                    None,
                ),
                ("http://unitsofmeasure.org", "UCUM", "UCUM", None, None),
            ],
        )
    ],
}

# Where codes of a non-standard vocabulary lead.
NON_STANDARD_TARGETS = {
    "ICD10CM": "SNOMED (Condition)",
    "ICD9CM": "SNOMED (Condition)",
    "ICD10PCS": "SNOMED (Procedure)",
    "ICD9Proc": "SNOMED (Procedure)",
    "CPT4": "SNOMED (Procedure), sometimes Measurement",
    "HCPCS": "SNOMED (Procedure / Device)",
    "NDC": "RxNorm (Drug)",
    "CVX": "RxNorm (Drug)",
}

_RESOURCE = (
    "struct<resourceType:string,id:string,group:array<struct<source:string,"
    "extension:array<struct<url:string,valueString:string>>,"
    "element:array<struct<code:string,display:string,"
    "target:array<struct<code:string,display:string,equivalence:string>>>>>>>"
)


def _finish(rows: DataFrame, concept: DataFrame | None) -> DataFrame:
    rows = rows.withColumn(
        "concept_id", F.when(F.col("target_code").rlike("^[0-9]+$"), F.col("target_code").try_cast("int"))
    )
    if concept is None:
        return rows.withColumn("source_concept_id", F.lit(0))
    known = concept.select(
        F.col("vocabulary_id").alias("source_vocabulary"),
        F.col("concept_code").alias("source_code"),
        F.col("concept_id").alias("_source_concept"),
    )
    known = known.groupBy("source_vocabulary", "source_code").agg(F.min("_source_concept").alias("_source_concept"))
    # The map is the small side here; the vocabulary is only scanned.
    rows = rows.join(known, ["source_vocabulary", "source_code"], "left")
    return rows.withColumn("source_concept_id", F.coalesce("_source_concept", F.lit(0)))


def _map_columns(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        *extra,
        "source_code",
        "concept_id",
        "source_concept_id",
        "target_code",
        "source_display",
        "target_display",
        "equivalence",
    )


def built_in(spark: SparkSession, map_id: str, concept: DataFrame | None = None) -> DataFrame:
    rows = [(vocab, *row) for vocab, group in BUILT_IN[map_id] for row in group]
    df = spark.createDataFrame(
        rows,
        "source_vocabulary string, source_code string, source_display string, target_code string, "
        "target_display string, equivalence string",
    )
    declares = any(vocab for vocab, _ in BUILT_IN[map_id])
    return _map_columns(_finish(df, concept if declares else None))


def build_all(spark: SparkSession, concept: DataFrame | None = None) -> dict[str, DataFrame]:
    return {map_id: built_in(spark, map_id, concept) for map_id in BUILT_IN}


def from_resources(texts: DataFrame, concept: DataFrame | None = None, column: str = "value") -> DataFrame:
    """Rows ``(map_id, …)`` of ConceptMap JSON texts: groups flattened, first target only.

    A vocabulary for source concepts is declared by a group extension ending in ``source-vocabulary``.
    """
    parsed = texts.select(F.from_json(F.col(column), _RESOURCE).alias("m")).where("m.resourceType = 'ConceptMap'")
    groups = parsed.select(F.col("m.id").alias("map_id"), F.explode("m.group").alias("g"))
    declared = F.filter("g.extension", lambda e: e.getField("url").endswith("source-vocabulary"))
    elements = groups.select(
        "map_id",
        F.get(declared, F.lit(0)).getField("valueString").alias("source_vocabulary"),
        F.explode("g.element").alias("e"),
    )
    rows = elements.select(
        F.regexp_replace("map_id", "-", "_").alias("map_id"),
        "source_vocabulary",
        F.col("e.code").alias("source_code"),
        F.col("e.display").alias("source_display"),
        F.get("e.target", F.lit(0)).alias("t"),
    ).where(F.col("t").isNotNull())
    rows = rows.select(
        "*",
        F.col("t.code").alias("target_code"),
        F.col("t.display").alias("target_display"),
        F.col("t.equivalence").alias("equivalence"),
    )
    return _map_columns(_finish(rows, concept), "map_id")


def require_unique(rows: DataFrame, *keys: str) -> DataFrame:
    """A source code mapped twice is an error."""
    doubled = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if doubled:
        raise ValueError(f"duplicate source code in a concept map: {doubled[0].asDict()}")
    return rows


def attach(df: DataFrame, concept_map: DataFrame, key: Column, **columns: str) -> DataFrame:
    """Left lookup in a concept map, e.g. ``attach(df, country, F.col('country'), country_id='concept_id')``.

    Built-in maps hold at most twenty rows, so they are always broadcast.
    """
    side = concept_map.select(
        F.col("source_code").alias("_map_key"), *[F.col(c).alias(name) for name, c in columns.items()]
    )
    return df.join(F.broadcast(side), key == F.col("_map_key"), "left").drop("_map_key")
