"""Clinical inputs derived by Spark from the given tables: FHIR resources as JSON, and a vocabulary.

Every frame reads a whole table and grows with it. The oracle side restates the same facts as plain columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.terminology import Vocabulary

TABLES = "region nation customer supplier part orders lineitem events documents".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The given files have one row group; parsing JSON deserves more than one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


VOCABULARY_BY_DIGIT = ["SNOMED", "LOINC", "RxNorm", "ICD10CM", "NDC", "CVX", "SNOMED", "CPT4", "LOINC", "SNOMED"]
SYSTEM_OF = {
    "SNOMED": "http://snomed.info/sct",
    "LOINC": "http://loinc.org",
    "RxNorm": "http://www.nlm.nih.gov/research/umls/rxnorm",
    "ICD10CM": "http://hl7.org/fhir/sid/icd-10-cm",
    "NDC": "http://hl7.org/fhir/sid/ndc",
    "CVX": "http://hl7.org/fhir/sid/cvx",
    "CPT4": "http://www.ama-assn.org/go/cpt",
}


def digit_case(expr: str, values: list[str]) -> str:
    """The same CASE text works in both engines."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE ({expr}) % 10 {whens} END)"


def vocabulary_of(expr: str) -> str:
    return digit_case(expr, VOCABULARY_BY_DIGIT)


def system_of(expr: str) -> str:
    return digit_case(expr, [SYSTEM_OF[v] for v in VOCABULARY_BY_DIGIT])


DOMAIN = (
    "(CASE p_type WHEN 'ECONOMY' THEN 'Condition' WHEN 'STANDARD' THEN 'Drug' WHEN 'MEDIUM' THEN 'Measurement' "
    "WHEN 'PROMO' THEN 'Procedure' WHEN 'SMALL' THEN 'Observation' "
    "ELSE CASE WHEN p_size % 2 = 0 THEN 'Device' ELSE 'Specimen' END END)"
)

CONCEPT_SQL = f"""
SELECT CAST(p_partkey + 1 AS INT) AS concept_id, p_name AS concept_name, {DOMAIN} AS domain_id,
       {vocabulary_of('p_partkey')} AS vocabulary_id,
       CASE WHEN p_size % 3 = 0 THEN 'Ingredient' ELSE 'Clinical Finding' END AS concept_class_id,
       CASE WHEN p_size % 4 <> 0 THEN 'S' END AS standard_concept,
       concat('C', p_partkey) AS concept_code,
       DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CASE WHEN p_size % 11 = 0 THEN 'D' END AS invalid_reason
FROM part
UNION ALL
SELECT CAST(900000000 + n_nationkey AS INT), n_name, 'Unit', 'UCUM', 'Unit', 'S', n_name,
       DATE '1970-01-01', DATE '2099-12-31', NULL
FROM nation
UNION ALL
SELECT CAST(910000000 + r_regionkey AS INT), r_name, 'Gender', 'Gender', 'Gender', 'S',
       CASE r_regionkey WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'OTH' ELSE r_name END,
       DATE '1970-01-01', DATE '2099-12-31', NULL
FROM region
"""

RELATIONSHIP_SQL = """
SELECT CAST(p_partkey + 1 AS INT) AS concept_id_1, CAST(p_partkey + 1 AS INT) AS concept_id_2,
       'Maps to' AS relationship_id, DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
       CAST(NULL AS VARCHAR(1)) AS invalid_reason
FROM part WHERE p_size % 4 <> 0
UNION ALL
SELECT CAST(p_partkey + 1 AS INT), CAST(p_partkey + 2 AS INT), 'Maps to', DATE '1970-01-01', DATE '2099-12-31',
       CASE WHEN p_size % 7 = 0 THEN 'D' END
FROM part WHERE p_size % 4 = 0
UNION ALL
SELECT CAST(p_partkey + 1 AS INT), CAST(p_partkey + 4 AS INT), 'Maps to', DATE '1970-01-01', DATE '2099-12-31', NULL
FROM part WHERE p_size % 8 = 0
UNION ALL
SELECT CAST(p_partkey + 1 AS INT), CAST(p_partkey + 2 AS INT), 'Is a', DATE '1970-01-01', DATE '2099-12-31', NULL
FROM part
"""

# Every part rolls up to the ingredient of its block of eight.
ANCESTOR_SQL = """
SELECT CAST(a.p_partkey + 1 AS INT) AS ancestor_concept_id, CAST(d.p_partkey + 1 AS INT) AS descendant_concept_id
FROM part d JOIN part a ON a.p_partkey = d.p_partkey - d.p_partkey % 8
UNION ALL
SELECT CAST(p_partkey + 1 AS INT), CAST(p_partkey + 1 AS INT) FROM part WHERE p_partkey % 8 <> 0
"""

_seen: dict[tuple[str, str], Vocabulary] = {}


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def vocabulary(spark: SparkSession, sf_dir: str) -> Vocabulary:
    """Built once per session and folder, so its size is counted once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _seen:
        views(spark, sf_dir, "part", "nation", "region")
        _seen[key] = Vocabulary(
            spark.sql(CONCEPT_SQL).withColumn("invalid_reason", F.col("invalid_reason").cast("string")),
            spark.sql(RELATIONSHIP_SQL).withColumn("invalid_reason", F.col("invalid_reason").cast("string")),
            spark.sql(ANCESTOR_SQL),
        )
    return _seen[key]


# --- FHIR resources -------------------------------------------------------------------------------

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))"
DAY = "date_format(l_shipdate, 'yyyy-MM-dd')"
BASE = "(l_partkey - l_partkey % 10)"
SECOND = "((l_partkey * 7 + l_linenumber) % 200)"


def _coding(key: str, display: str = "CAST(NULL AS STRING)") -> str:
    return f"named_struct('system', {system_of(key)}, 'code', concat('C', {key}), 'display', {display})"


def _fixed(vocab: str, code: str, when: str = "true") -> str:
    struct = f"named_struct('system', '{SYSTEM_OF[vocab]}', 'code', concat('C', {code}))"
    return f"CASE WHEN {when} THEN {struct} END"


def _codings(*entries: str) -> str:
    return f"named_struct('coding', filter(array({', '.join(entries)}), x -> x IS NOT NULL), 'text', 'free text')"


def _ref(expr: str) -> str:
    return f"named_struct('reference', {expr})"


def _status(expr: str) -> str:
    return f"named_struct('coding', array(named_struct('code', {expr})))"


_SUBJECT = _ref("concat('Patient/p', l_orderkey % 997)")
_ENCOUNTER = _ref("concat('Encounter/e', l_orderkey)")
_BOTH = _codings(_coding("l_partkey", "CASE WHEN l_partkey % 3 = 0 THEN concat('D', l_partkey) END"), _coding(SECOND))
_MEDICATION = _codings(
    _fixed("RxNorm", f"{BASE} + 2", "l_linenumber % 2 = 1"), _fixed("NDC", f"{BASE} + 4")
)

_LINE: dict[str, list[tuple[str, str]]] = {
    "Condition": [
        ("subject", _SUBJECT),
        ("encounter", _ref("concat('urn:uuid:e', l_orderkey)")),
        ("recorder", _ref("concat('Practitioner/s', l_suppkey)")),
        (
            "asserter",
            "CASE WHEN l_linenumber % 2 = 0 THEN "
            + _ref("concat('https://host.example/fhir/Practitioner/a', l_suppkey, '/_history/2')")
            + " END",
        ),
        ("code", _BOTH),
        ("evidence", f"array(named_struct('concept', {_codings(_coding(SECOND))}))"),
        (
            "category",
            "array("
            + _status(
                "CASE l_returnflag WHEN 'A' THEN 'encounter-diagnosis' WHEN 'N' THEN 'problem-list-item' ELSE 'other' END"
            )
            + ")",
        ),
        ("clinicalStatus", _status("CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'resolved' END")),
        (
            "verificationStatus",
            _status(
                "CASE l_linenumber WHEN 1 THEN 'refuted' WHEN 2 THEN 'provisional' WHEN 3 THEN NULL "
                "WHEN 4 THEN 'entered-in-error' WHEN 5 THEN 'unconfirmed' ELSE 'confirmed' END"
            ),
        ),
        ("onsetDateTime", f"CASE WHEN l_returnflag = 'A' THEN concat({DAY}, 'T23:30:00-05:00') END"),
        ("onsetPeriod", f"CASE WHEN l_returnflag = 'N' THEN named_struct('start', {DAY}) END"),
        ("recordedDate", "'1999-09-09'"),
        ("abatementDateTime", f"CASE WHEN l_linestatus = 'F' THEN concat({DAY}, 'T01:00:00Z') END"),
        ("abatementString", "'a string of more than twenty characters'"),
    ],
    "DiagnosticReport": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'cancelled' WHEN 2 THEN NULL ELSE 'final' END"),
        ("subject", _SUBJECT),
        ("encounter", _ENCOUNTER),
        (
            "performer",
            f"array({_ref(chr(39) + 'Organization/g1' + chr(39))}, {_ref('concat(' + chr(39) + 'Practitioner/s' + chr(39) + ', l_suppkey)')})",
        ),
        ("code", _BOTH),
        ("effectiveDateTime", f"concat({DAY}, 'T10:15:00+02:00')"),
    ],
    "Procedure": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'not-done' WHEN 2 THEN NULL ELSE 'completed' END"),
        ("subject", _SUBJECT),
        ("encounter", _ENCOUNTER),
        ("code", _codings(_fixed("CPT4", f"{BASE} + 7"), _fixed("SNOMED", BASE, "l_linenumber % 2 = 0"))),
        ("performedDateTime", f"CASE WHEN l_returnflag <> 'R' THEN concat({DAY}, 'T23:30:00-05:00') END"),
        (
            "performedPeriod",
            f"CASE WHEN l_returnflag = 'R' THEN named_struct('start', concat({DAY}, 'T08:00:00Z'), "
            f"'end', concat({DAY}, 'T22:00:00-03:00')) END",
        ),
        ("performer", f"array(named_struct('actor', {_ref('concat(' + chr(39) + 'Practitioner/s' + chr(39) + ', l_suppkey)')}))"),
    ],
    "MedicationRequest": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'draft' WHEN 2 THEN NULL ELSE 'active' END"),
        ("subject", _SUBJECT),
        ("encounter", _ENCOUNTER),
        ("requester", _ref("concat('Practitioner/s', l_suppkey)")),
        ("medicationCodeableConcept", _MEDICATION),
        ("authoredOn", f"concat({DAY}, 'T12:00:00+01:00')"),
    ],
    "MedicationAdministration": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'not-done' WHEN 2 THEN NULL ELSE 'completed' END"),
        ("subject", _SUBJECT),
        ("context", _ENCOUNTER),
        (
            "medicationCodeableConcept",
            _codings(
                _fixed("SNOMED", f"{BASE} + 6"),
                _fixed("NDC", f"{BASE} + 4", "l_linenumber % 3 = 0"),
                _fixed("RxNorm", f"{BASE} + 2", "l_linenumber % 2 = 1"),
            ),
        ),
        ("effectiveDateTime", f"concat({DAY}, 'T12:00:00+01:00')"),
    ],
    "MedicationDispense": [
        ("subject", _SUBJECT),
        ("context", _ENCOUNTER),
        ("medicationCodeableConcept", _MEDICATION),
        ("whenHandedOver", DAY),
        ("quantity", "named_struct('value', l_quantity)"),
        ("daysSupply", "named_struct('value', l_linenumber * 10)"),
    ],
    "MedicationStatement": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'cancelled' WHEN 2 THEN NULL ELSE 'active' END"),
        ("subject", _SUBJECT),
        ("context", _ENCOUNTER),
        ("medicationCodeableConcept", _MEDICATION),
        ("effectiveDateTime", f"CASE WHEN l_returnflag = 'R' THEN {DAY} END"),
        (
            "effectivePeriod",
            f"CASE WHEN l_returnflag <> 'R' THEN named_struct('start', {DAY}, 'end', "
            "CASE WHEN l_returnflag = 'A' THEN date_format(date_add(CAST(l_shipdate AS DATE), 9), 'yyyy-MM-dd') END) END",
        ),
    ],
    "Immunization": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'not-done' WHEN 2 THEN NULL ELSE 'completed' END"),
        ("patient", _SUBJECT),
        ("encounter", _ENCOUNTER),
        (
            "vaccineCode",
            _codings(_fixed("CVX", f"{BASE} + 5", "l_linenumber % 2 = 0"), _fixed("RxNorm", f"{BASE} + 2")),
        ),
        ("occurrenceDateTime", DAY),
    ],
    "AllergyIntolerance": [
        ("patient", _SUBJECT),
        ("encounter", _ENCOUNTER),
        ("code", _codings(_fixed("SNOMED", f"{BASE} + 9", "l_linenumber % 2 = 1"), _fixed("RxNorm", f"{BASE} + 2"))),
        ("recordedDate", f"CASE WHEN l_returnflag = 'A' THEN {DAY} END"),
        ("onsetDateTime", "'2001-02-03T04:05:06Z'"),
        ("clinicalStatus", _status("CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'resolved' END")),
        ("verificationStatus", _status("CASE l_linenumber WHEN 1 THEN 'refuted' WHEN 2 THEN NULL ELSE 'confirmed' END")),
    ],
    "Device": [
        ("status", "CASE l_linenumber WHEN 1 THEN 'entered-in-error' WHEN 2 THEN 'inactive' ELSE 'active' END"),
        ("patient", _SUBJECT),
        ("type", _codings(_fixed("SNOMED", f"{BASE} + 6"))),
        ("udiCarrier", "array(named_struct('deviceIdentifier', concat('udi', l_suppkey)))"),
        ("lotNumber", "concat('lot', l_linenumber)"),
        ("manufactureDate", f"concat({DAY}, 'T00:00:00Z')"),
        ("expirationDate", "CASE WHEN l_linestatus = 'F' THEN '2030-01-01' END"),
    ],
    "Specimen": [
        ("subject", _SUBJECT),
        ("type", _codings(_fixed("SNOMED", BASE))),
        (
            "collection",
            f"named_struct('collectedDateTime', CASE WHEN l_linenumber <> 1 THEN concat({DAY}, 'T07:00:00Z') END, "
            f"'bodySite', {_codings(_fixed('SNOMED', BASE + ' + 9'))}, 'quantity', named_struct('value', l_quantity))",
        ),
    ],
}

_PREFIX = {
    "Condition": "c",
    "DiagnosticReport": "r",
    "Procedure": "x",
    "MedicationRequest": "mr",
    "MedicationAdministration": "ma",
    "MedicationDispense": "md",
    "MedicationStatement": "ms",
    "Immunization": "im",
    "AllergyIntolerance": "al",
    "Device": "dv",
    "Specimen": "sp",
}

CITY = "c_nationkey"
_EXT = "http://hl7.org/fhir/us/core/StructureDefinition/"


def _ext_row(url: str, member: str, value: str, nested: str = "NULL") -> str:
    """All extensions of a list need one struct type."""
    members = {
        "valueCode": "CAST(NULL AS STRING)",
        "valueString": "CAST(NULL AS STRING)",
        "valueDateTime": "CAST(NULL AS STRING)",
        "valueDecimal": "CAST(NULL AS DOUBLE)",
        "valueCoding": "CAST(NULL AS STRUCT<code:STRING,display:STRING>)",
    }
    if member:
        members[member] = value
    body = ", ".join(f"'{k}', {v}" for k, v in members.items())
    return f"named_struct('url', '{url}', {body}{'' if nested == 'NULL' else ', ' + repr('extension') + ', ' + nested})"


def _nested(url: str, inner: list[str]) -> str:
    return _ext_row(url, "", "", f"array({', '.join(inner)})")


_NO_INNER = (
    "CAST(NULL AS ARRAY<STRUCT<url:STRING,valueCode:STRING,valueString:STRING,valueDateTime:STRING,"
    "valueDecimal:DOUBLE,valueCoding:STRUCT<code:STRING,display:STRING>>>)"
)


def _flat(url: str, member: str, value: str) -> str:
    return _ext_row(url, member, value, _NO_INNER)


_CODE = "named_struct('code', {0}, 'display', CAST({1} AS STRING))"
RACE_CODE = (
    "(CASE c_custkey % 8 WHEN 0 THEN '2106-3' WHEN 1 THEN '2054-5' WHEN 2 THEN '2028-9' WHEN 3 THEN 'UNK' "
    "WHEN 4 THEN 'UNK' WHEN 5 THEN '9999-9' END)"
)
RACE_TEXT = "(CASE c_custkey % 8 WHEN 3 THEN 'Other' WHEN 4 THEN 'Mixed' ELSE 'Some race' END)"
BIRTH = "date_format(date_add(DATE '1950-01-01', CAST(c_custkey % 20000 AS INT)), 'yyyy-MM-dd')"
_ADDRESS = (
    "named_struct('use', {use}, 'line', array(concat('L', c_nationkey), 'floor 1'), 'city', concat('{city}', c_nationkey), "
    "'state', concat('S', c_nationkey % 5), 'postalCode', CASE WHEN c_nationkey % 4 <> 0 THEN concat('Z', c_nationkey) END, "
    "'district', 'district', 'country', CASE c_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' ELSE 'FR' END, "
    "'extension', array(" + "{geo}" + "))"
)
_GEO = _nested(
    "http://hl7.org/fhir/StructureDefinition/geolocation",
    [
        _ext_row("latitude", "valueDecimal", "CAST(c_nationkey AS DOUBLE) + 0.25"),
        _ext_row("longitude", "valueDecimal", "CAST(c_nationkey AS DOUBLE) - 0.5"),
    ],
)

_OTHER: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "Patient": (
        "customer",
        "concat('p', c_custkey)",
        [
            ("gender", "CASE c_custkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' WHEN 3 THEN 'odd' END"),
            ("birthDate", BIRTH),
            (
                "_birthDate",
                "CASE WHEN c_custkey % 4 = 0 THEN named_struct('extension', array("
                + _flat("http://hl7.org/fhir/StructureDefinition/patient-birthTime", "valueDateTime", f"concat({BIRTH}, 'T22:15:00-08:00')")
                + ")) END",
            ),
            ("deceasedDateTime", "CASE WHEN c_custkey % 6 = 0 THEN '2020-05-06T23:59:00-04:00' END"),
            ("deceasedBoolean", "CASE WHEN c_custkey % 6 = 1 THEN true END"),
            (
                "extension",
                "array("
                + ", ".join(
                    [
                        _nested(
                            _EXT + "us-core-race",
                            [
                                _ext_row("ombCategory", "valueCoding", _CODE.format(RACE_CODE, "NULL")),
                                _ext_row("text", "valueString", RACE_TEXT),
                            ],
                        ),
                        _nested(
                            _EXT + "us-core-ethnicity",
                            [
                                _ext_row(
                                    "ombCategory",
                                    "valueCoding",
                                    _CODE.format("CASE c_custkey % 3 WHEN 0 THEN '2135-2' WHEN 1 THEN '2186-5' END", "NULL"),
                                ),
                                _ext_row("text", "valueString", "'Some ethnicity'"),
                            ],
                        ),
                        _flat(_EXT + "us-core-birthsex", "valueCode", "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END"),
                        _flat(
                            "https://host.example/StructureDefinition/omop-race",
                            "valueCoding",
                            _CODE.format("CASE WHEN c_custkey % 9 = 0 THEN '8557' END", "CASE WHEN c_custkey % 9 = 0 THEN 'native' END"),
                        ),
                    ]
                )
                + ")",
            ),
            (
                "address",
                "CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 2 = 0 THEN array("
                + _ADDRESS.format(use="'home'", city="H", geo=_GEO)
                + ", "
                + _ADDRESS.format(use="'official'", city="O", geo=_GEO)
                + ") ELSE array("
                + _ADDRESS.format(use="'home'", city="H", geo=_GEO)
                + ") END",
            ),
            ("generalPractitioner", f"array({_ref('concat(' + chr(39) + 'Practitioner/s' + chr(39) + ', c_nationkey)')})"),
            ("managingOrganization", _ref("concat('Organization/g', c_nationkey)")),
        ],
    ),
    "Practitioner": (
        "supplier",
        "concat('s', s_suppkey)",
        [
            (
                "identifier",
                "array(named_struct('system', 'http://hl7.org/fhir/sid/us-npi', 'value', concat('99', s_suppkey)))",
            ),
            ("name", "array(named_struct('family', s_name, 'given', CASE WHEN s_suppkey % 2 = 0 THEN array('Ann', 'B') ELSE array('B') END))"),
            ("gender", "CASE s_suppkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' WHEN 3 THEN 'unknown' END"),
        ],
    ),
    "PractitionerRole": (
        "supplier",
        "concat('pr', s_suppkey)",
        [
            ("practitioner", _ref("concat('Practitioner/s', s_suppkey - s_suppkey % 2)")),
            ("organization", "CASE WHEN s_suppkey % 3 = 0 THEN " + _ref("concat('Organization/g', s_nationkey)") + " END"),
            ("specialty", f"array({_codings(_fixed('SNOMED', '(s_suppkey % 20) * 10'))})"),
        ],
    ),
    "Organization": (
        "supplier",
        "concat('g', s_suppkey)",
        [
            ("name", "s_name"),
            (
                "type",
                "array("
                + _status(
                    "CASE s_nationkey % 6 WHEN 0 THEN 'prov' WHEN 1 THEN 'dept' WHEN 2 THEN 'edu' WHEN 3 THEN 'govt' WHEN 4 THEN 'team' ELSE 'other' END"
                )
                + ")",
            ),
        ],
    ),
    "Location": (
        "supplier",
        "concat('loc', s_suppkey)",
        [
            ("name", "s_name"),
            ("type", f"array({_codings(_fixed('SNOMED', 's_nationkey'))})"),
            (
                "address",
                "named_struct('line', array('1 Road', concat('Box ', s_suppkey)), 'city', concat('City', s_nationkey), 'state', concat('State ', s_nationkey), "
                "'postalCode', concat('12345-67890', s_nationkey), 'country', CASE s_nationkey % 2 WHEN 0 THEN 'DE' ELSE 'XX' END)",
            ),
            ("position", "named_struct('latitude', s_acctbal, 'longitude', -s_acctbal)"),
        ],
    ),
    "Encounter": (
        "orders",
        "concat('e', o_orderkey)",
        [
            ("status", "CASE o_orderstatus WHEN 'P' THEN 'planned' WHEN 'F' THEN 'finished' END"),
            (
                "class",
                "named_struct('code', CASE o_orderpriority WHEN '1-URGENT' THEN 'EMER' WHEN '2-HIGH' THEN 'IMP' WHEN '3-MEDIUM' THEN 'AMB' WHEN '5-LOW' THEN 'VR' ELSE 'ZZZ' END)",
            ),
            ("subject", _ref("concat('Patient/p', o_custkey)")),
            (
                "period",
                "named_struct('start', concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T22:30:00-04:00'), 'end', "
                "CASE WHEN o_orderkey % 3 <> 0 THEN concat(date_format(date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 9 AS INT)), 'yyyy-MM-dd'), 'T23:00:00Z') END)",
            ),
            ("serviceProvider", _ref("concat('Organization/g', o_custkey % 7)")),
            ("participant", f"array(named_struct('individual', {_ref('concat(' + chr(39) + 'Practitioner/s' + chr(39) + ', o_custkey % 10)')}))"),
            ("partOf", "CASE WHEN o_orderkey % 5 = 0 THEN " + _ref("concat('Encounter/e', o_orderkey - 1)") + " END"),
            (
                "hospitalization",
                "named_struct('admitSource', " + _status("'emd'") + ", 'dischargeDisposition', " + _status("CASE WHEN o_orderkey % 2 = 0 THEN 'home' END") + ")",
            ),
        ],
    ),
    "Coverage": (
        "orders",
        "concat('v', o_orderkey)",
        [
            ("beneficiary", _ref("concat('Patient/p', o_custkey)")),
            (
                "period",
                "named_struct('start', CASE WHEN o_orderstatus <> 'P' THEN date_format(o_orderdate, 'yyyy-MM-dd') END, "
                "'end', CASE WHEN o_orderkey % 2 = 0 THEN date_format(date_add(CAST(o_orderdate AS DATE), 365), 'yyyy-MM-dd') END)",
            ),
            ("payor", "array(named_struct('display', concat('Payer ', o_custkey % 6)))"),
            ("type", "named_struct('text', o_orderpriority)"),
        ],
    ),
    "Medication": (
        "part",
        "concat('m', p_partkey)",
        [("code", _codings(_fixed("RxNorm", "p_partkey"), _fixed("NDC", "p_partkey")))],
    ),
    "Observation": (
        "events",
        "concat('o', event_id)",
        [
            ("status", "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'cancelled' WHEN event_id % 7 <> 0 THEN 'final' END"),
            ("subject", _ref("concat('Patient/p', user_id)")),
            ("encounter", _ref("concat('Encounter/e', event_id % 1000)")),
            ("performer", f"array({_ref('concat(' + chr(39) + 'Practitioner/s' + chr(39) + ', user_id % 10)')})"),
            (
                "code",
                _codings(_coding("event_id % 200"), _coding("(event_id * 3 + 1) % 200")),
            ),
            ("effectiveDateTime", "CASE WHEN event_id % 2 = 0 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '-06:00') END"),
            ("effectivePeriod", "CASE WHEN event_id % 2 = 1 THEN named_struct('start', date_format(ts, 'yyyy-MM-dd')) END"),
            (
                "valueQuantity",
                "CASE WHEN event_type IN ('click', 'view', 'error') THEN named_struct('value', value, 'unit', concat('unit ', user_id % 30), "
                "'code', concat('NATION_', user_id % 30), 'comparator', "
                "CASE event_id % 6 WHEN 0 THEN '<' WHEN 1 THEN '<=' WHEN 2 THEN '>=' WHEN 3 THEN '>' WHEN 4 THEN '~' END) END",
            ),
            ("valueString", "CASE WHEN event_type = 'signup' AND event_id % 4 <> 0 THEN concat('text ', event_id) END"),
            (
                "valueCodeableConcept",
                f"CASE WHEN event_type = 'purchase' THEN named_struct('coding', array({_coding('user_id % 200')}), 'text', concat('answer ', user_id)) END",
            ),
            ("interpretation", "CASE WHEN value > 50 THEN array(" + _status("'H'") + ") END"),
            (
                "referenceRange",
                "CASE WHEN event_id % 2 = 0 THEN array(named_struct('low', named_struct('value', value - 1), 'high', named_struct('value', value * 2))) END",
            ),
            (
                "component",
                "CASE WHEN event_id % 3 <> 2 THEN array("
                + "named_struct('code', "
                + _codings(_coding("(event_id + 1) % 200"))
                + ", 'valueQuantity', named_struct('value', value, 'unit', 'u', 'code', concat('NATION_', user_id % 30)), "
                "'valueCodeableConcept', CAST(NULL AS STRUCT<coding:ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>,text:STRING>), "
                "'valueString', CAST(NULL AS STRING)), "
                + "named_struct('code', "
                + _codings(_coding("(event_id + 2) % 200"))
                + ", 'valueQuantity', CAST(NULL AS STRUCT<value:DOUBLE,unit:STRING,code:STRING>), 'valueCodeableConcept', "
                f"CASE WHEN event_id % 2 = 0 THEN named_struct('coding', array({_coding('user_id % 200')}), 'text', CAST(NULL AS STRING)) END, "
                "'valueString', CASE WHEN event_id % 2 = 1 THEN concat('part ', user_id) END)) END",
            ),
        ],
    ),
}


def _json_rows(df: DataFrame, resource_type: str, id_expr: str, members: list[tuple[str, str]]) -> DataFrame:
    body = ", ".join(f"'{name}', {expr}" for name, expr in members)
    return df.selectExpr(
        f"'{resource_type}' AS resource_type",
        f"{id_expr} AS id",
        f"to_json(named_struct('resourceType', '{resource_type}', 'id', {id_expr}, {body})) AS resource",
    )


def line_id(resource_type: str) -> str:
    return f"concat('{_PREFIX[resource_type]}-', {LINE_ID})"


def resources(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """``(resource_type, id, resource)`` rows of the given types."""
    parts = []
    for t in types:
        if t in _LINE:
            parts.append(_json_rows(spread(table(spark, sf_dir, "lineitem")), t, line_id(t), _LINE[t]))
        else:
            source, id_expr, members = _OTHER[t]
            parts.append(_json_rows(spread(table(spark, sf_dir, source)), t, id_expr, members))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def note_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnostic reports that carry the document texts, whole."""
    members = [
        ("status", "CASE WHEN doc_id % 11 = 0 THEN 'unknown' WHEN doc_id % 5 = 0 THEN NULL ELSE 'final' END"),
        ("subject", _ref("concat('Patient/p', doc_id % 997)")),
        ("performer", f"array({_ref('concat(' + chr(39) + 'Practitioner/s' + chr(39) + ', doc_id % 10)')})"),
        (
            "code",
            f"named_struct('coding', array({_fixed('LOINC', '(doc_id % 20) * 10 + 1')}), 'text', concat('title ', source))",
        ),
        ("effectiveDateTime", "CASE WHEN doc_id % 13 <> 0 THEN '2021-03-04T05:06:07Z' END"),
        ("presentedForm", "CASE WHEN doc_id % 3 <> 0 THEN array(named_struct('data', base64(encode(text, 'UTF-8')))) END"),
        ("conclusion", "CASE WHEN doc_id % 2 = 0 THEN concat('concluded ', lang) END"),
    ]
    df = spread(table(spark, sf_dir, "documents"))
    return _json_rows(df, "DiagnosticReport", "concat('n', doc_id)", members)
