"""Registered queries of the CSV path and of the temporal operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import csv_mirror as C
from checks import mirror as M
from checks.fhir_queries import Build, doubles, hk
from medloom.operators import temporal as TM
from medloom.operators import terminology as V
from medloom.plans import csv_cdm as P
from medloom.session import checkpointed

Q: dict[str, Build] = {}
SQL: dict[str, str] = {}


def register(name: str, build: Build, sql: str | None = None) -> None:
    Q[name] = build
    if sql is not None:
        SQL[name] = sql


def from_sources(
    build: Callable[[P.Sources], DataFrame], columns: str | None = None, materialize: bool = False, stored: bool = False
) -> Build:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(C.sources(spark, sf_dir, materialize, stored))
        return doubles(df.select(*columns.split()) if columns else df)

    return run


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


# --- interval merging -----------------------------------------------------------------------------


def runs(name: str, source: str, keys: str, start: str, end: str, pad: int) -> str:
    """Ends of merged intervals, by a sweep over days: a run ends on a day after which no interval (longer by ``pad``) is open."""
    return f"""
{name}_days AS (
  SELECT {keys}, day, sum(step) AS step FROM (
    SELECT {keys}, {start} AS day, 1 AS step FROM {source} UNION ALL SELECT {keys}, {end} + {pad}, -1 FROM {source})
  WHERE day IS NOT NULL GROUP BY {keys}, day),
{name}_ends AS (
  SELECT {keys}, day - {pad} AS run_end FROM (
    SELECT *, sum(step) OVER (PARTITION BY {keys} ORDER BY day) AS still_open FROM {name}_days)
  WHERE still_open = 0)"""


VISITS = f"""
ip_rows AS (SELECT * FROM encounters WHERE encounterclass = 'inpatient'),
{runs('ip', 'ip_rows', 'patient', 'start', 'stop', 1).strip()},
ip AS (
  SELECT encounter_id, patient, 'inpatient' AS encounterclass, start AS visit_start_date, min(run_end) AS visit_end_date
  FROM (SELECT patient, start, min(id) AS encounter_id FROM ip_rows GROUP BY patient, start) r
  JOIN ip_ends USING (patient) WHERE run_end >= start GROUP BY ALL),
er AS (SELECT min(id) AS encounter_id, patient, encounterclass, start AS visit_start_date, max(stop) AS visit_end_date
       FROM encounters WHERE encounterclass IN ('emergency', 'urgent') GROUP BY patient, encounterclass, start),
op AS (SELECT min(id) AS encounter_id, patient, encounterclass, start AS visit_start_date, max(stop) AS visit_end_date
       FROM encounters WHERE encounterclass IN ('ambulatory', 'wellness', 'outpatient')
       GROUP BY patient, encounterclass, start),
visits AS (
  SELECT *, {hk('encounter_id')} AS visit_occurrence_id
  FROM (SELECT * FROM ip UNION ALL SELECT * FROM er UNION ALL SELECT * FROM op)),
pairs AS (
  SELECT e.id AS encounter_id, e.patient, e.start AS date_service, e.stop AS date_service_end, e.encounterclass,
         v.encounterclass AS visit_type, v.visit_start_date, v.visit_end_date, v.visit_occurrence_id,
         CASE WHEN e.encounterclass = 'inpatient' AND v.encounterclass = 'inpatient' THEN 1
              WHEN e.encounterclass IN ('emergency', 'urgent') AND v.encounterclass = 'inpatient'
                   AND e.start > v.visit_start_date THEN 1
              WHEN e.encounterclass IN ('emergency', 'urgent') AND v.encounterclass IN ('emergency', 'urgent')
                   AND e.start = v.visit_start_date THEN 2
              WHEN e.encounterclass IN ('ambulatory', 'wellness', 'outpatient') AND v.encounterclass = 'inpatient' THEN 1
              WHEN e.encounterclass IN ('ambulatory', 'wellness', 'outpatient')
                   AND v.encounterclass IN ('ambulatory', 'wellness', 'outpatient') THEN 2 END AS priority
  FROM encounters e JOIN visits v
    ON e.patient = v.patient AND e.start BETWEEN v.visit_start_date AND v.visit_end_date),
final AS (
  SELECT encounter_id, visit_occurrence_id AS visit_occurrence_id_new FROM (
    SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY priority,
      CASE WHEN visit_type = 'inpatient' THEN visit_start_date - DATE '2000-01-01'
           ELSE DATE '2000-01-01' - visit_start_date END, visit_occurrence_id) AS rn
    FROM pairs WHERE priority IS NOT NULL)
  WHERE rn = 1)"""
E = C.ctes("encounters")
_COLS = "encounter_id, patient, encounterclass, visit_start_date, visit_end_date"
register("visits_inpatient", from_sources(lambda s: TM.inpatient_visits(s["encounters"])), with_(E, VISITS) + f"SELECT {_COLS} FROM ip")
register("visits_emergency", from_sources(lambda s: TM.emergency_visits(s["encounters"])), with_(E, VISITS) + f"SELECT {_COLS} FROM er")
register("visits_outpatient", from_sources(lambda s: TM.outpatient_visits(s["encounters"])), with_(E, VISITS) + f"SELECT {_COLS} FROM op")
register("visits_all", from_sources(lambda s: s.visits), with_(E, VISITS) + f"SELECT {_COLS}, visit_occurrence_id FROM visits")
register(
    "visit_assignment",
    from_sources(
        lambda s: TM.assigned_visits(s["encounters"], s.visits),
        "encounter_id patient date_service encounterclass visit_type visit_start_date visit_end_date "
        "visit_occurrence_id visit_occurrence_id_new",
    ),
    with_(E, VISITS)
    + "SELECT encounter_id, patient, date_service, encounterclass, visit_type, visit_start_date, visit_end_date, "
    "visit_occurrence_id, CASE WHEN priority IS NOT NULL THEN visit_occurrence_id END AS visit_occurrence_id_new FROM pairs",
)
register("visit_final", from_sources(lambda s: s.final), with_(E, VISITS) + "SELECT * FROM final")

_CLASS = (
    "CASE encounterclass WHEN 'ambulatory' THEN 9202 WHEN 'wellness' THEN 9202 WHEN 'outpatient' THEN 9202 "
    "WHEN 'inpatient' THEN 9201 WHEN 'emergency' THEN 9203 WHEN 'urgentcare' THEN 9203 ELSE 0 END"
)
_VISIT_ROWS = f"""
known AS (SELECT id AS patient, {hk('id')} AS person_id FROM patients WHERE gender IS NOT NULL),
visit_rows AS (
  SELECT v.*, k.person_id, {hk('e.provider')} AS provider_id, {hk('e.organization')} AS care_site_id,
         lag(v.visit_occurrence_id) OVER (PARTITION BY k.person_id ORDER BY v.visit_start_date, v.visit_occurrence_id)
           AS previous
  FROM visits v JOIN known k USING (patient) JOIN encounters e ON e.id = v.encounter_id AND e.patient = v.patient
  WHERE v.visit_occurrence_id IN (SELECT visit_occurrence_id_new FROM final)
    AND e.provider IN (SELECT id FROM providers) AND e.organization IN (SELECT id FROM organizations))"""
_PEOPLE = C.ctes("patients", "providers", "organizations")
register(
    "csv_visit_occurrence",
    from_sources(
        P.visit_occurrence,
        "visit_occurrence_id person_id visit_concept_id visit_start_date visit_end_date provider_id care_site_id "
        "visit_source_value preceding_visit_occurrence_id",
        materialize=True,
    ),
    with_(E, _PEOPLE, VISITS, _VISIT_ROWS)
    + f"""
SELECT visit_occurrence_id, person_id, {_CLASS} AS visit_concept_id, visit_start_date, visit_end_date, provider_id,
       care_site_id, encounter_id AS visit_source_value, previous AS preceding_visit_occurrence_id FROM visit_rows""",
)
register(
    "csv_visit_detail",
    from_sources(
        P.visit_detail,
        "visit_detail_id person_id visit_detail_concept_id visit_detail_start_date visit_detail_end_date provider_id "
        "visit_detail_source_value preceding_visit_detail_id visit_occurrence_id",
        materialize=True,
    ),
    with_(E, _PEOPLE, VISITS, _VISIT_ROWS.replace(" AND e.organization IN (SELECT id FROM organizations)", ""))
    + f"""
SELECT visit_occurrence_id + 1000000 AS visit_detail_id, person_id, {_CLASS} AS visit_detail_concept_id,
       visit_start_date AS visit_detail_start_date, visit_end_date AS visit_detail_end_date, provider_id,
       encounter_id AS visit_detail_source_value, previous + 1000000 AS preceding_visit_detail_id,
       visit_occurrence_id FROM visit_rows""",
)

# --- eras -----------------------------------------------------------------------------------------


def _era_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("person_id"),
        (F.col("event_id") % 7).cast("int").alias("condition_concept_id"),
        F.col("ts").cast("date").alias("condition_start_date"),
        F.when(F.col("event_id") % 3 != 0, F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 4).cast("int"))).alias(
            "condition_end_date"
        ),
    )


for _pad in (30, 1):
    register(
        "condition_era" if _pad == 30 else "condition_era_short_gap",
        lambda spark, sf_dir, pad=_pad: TM.condition_eras(_era_rows(spark, sf_dir), persistence_days=pad).drop(
            "condition_era_id"
        ),
        with_(
            """
rows AS (
  SELECT user_id AS person_id, CAST(event_id % 7 AS INT) AS concept, CAST(ts AS DATE) AS s, event_id,
         CAST(ts AS DATE) + CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 4 AS INT) ELSE 1 END AS e FROM events)""",
            runs("era", "rows", "person_id, concept", "s", "e", _pad),
            """
placed AS (
  SELECT r.person_id, r.concept, r.event_id, r.s, min(run_end) AS run_end
  FROM rows r JOIN era_ends x ON x.person_id = r.person_id AND x.concept = r.concept AND run_end >= s GROUP BY ALL)""",
        )
        + """
SELECT person_id, concept AS condition_concept_id, min(s) AS condition_era_start_date, run_end AS condition_era_end_date,
       CAST(count(*) AS INT) AS condition_occurrence_count
FROM placed GROUP BY person_id, concept, run_end""",
    )

_EXPOSURE = f"""
SELECT CAST(o_custkey AS BIGINT) AS person_id, CAST(l_partkey + 1 AS INT) AS drug_concept_id,
       {C._LINE_DAY} AS drug_exposure_start_date,
       CASE WHEN l_returnflag = 'A' THEN {C._LINE_DAY} + CAST(l_quantity AS INT) END AS drug_exposure_end_date,
       CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity % 20 AS INT) - CASE WHEN l_linenumber = 7 THEN 5 ELSE 0 END END
         AS days_supply
FROM {C._LINES}"""


def _drug_era(spark: SparkSession, sf_dir: str) -> DataFrame:
    M.views(spark, sf_dir, "orders", "lineitem")
    vocabulary = M.vocabulary(spark, sf_dir)
    # Ingredients of every vocabulary take part here, so that the sample has eras to merge.
    concept = vocabulary.concept.withColumn("vocabulary_id", F.lit("RxNorm"))
    rows = TM.exposures_by_ingredient(spark.sql(_EXPOSURE), concept, vocabulary.ancestor)
    return TM.drug_eras(rows).drop("drug_era_id")


register(
    "drug_era",
    _drug_era,
    with_(
        f"concept AS ({M.CONCEPT_SQL})",
        f"ancestor AS ({M.ANCESTOR_SQL})",
        f"exposure AS ({_EXPOSURE})",
        """
rows AS (
  SELECT row_number() OVER () AS rid, person_id, a.ancestor_concept_id AS drug, drug_exposure_start_date AS s,
         coalesce(drug_exposure_end_date,
                  CASE WHEN days_supply <> 0 THEN drug_exposure_start_date + days_supply END,
                  drug_exposure_start_date + 1) AS e
  FROM exposure x JOIN ancestor a ON a.descendant_concept_id = x.drug_concept_id
  JOIN concept c ON c.concept_id = a.ancestor_concept_id AND c.concept_class_id = 'Ingredient'
  WHERE coalesce(days_supply, 0) >= 0)""",
        runs("sub", "rows", "person_id, drug", "s", "e", 0),
        """
placed AS (
  SELECT r.rid, r.person_id, r.drug, r.s, min(run_end) AS run_end
  FROM rows r JOIN sub_ends x ON x.person_id = r.person_id AND x.drug = r.drug AND run_end >= s GROUP BY ALL),
subs AS (SELECT person_id, drug, min(s) AS s, run_end AS e, count(*) AS n FROM placed GROUP BY person_id, drug, run_end)""",
        runs("era", "subs", "person_id, drug", "s", "e", 30),
        """
final AS (
  SELECT r.person_id, r.drug, r.s, r.e, r.n, min(run_end) AS run_end
  FROM subs r JOIN era_ends x ON x.person_id = r.person_id AND x.drug = r.drug AND run_end >= s GROUP BY ALL)""",
    )
    + """
SELECT person_id, drug AS drug_concept_id, min(s) AS drug_era_start_date, run_end AS drug_era_end_date,
       CAST(sum(n) AS INT) AS drug_exposure_count, CAST((run_end - min(s)) - sum(e - s) AS INT) AS gap_days
FROM final GROUP BY person_id, drug, run_end""",
)

# --- coded events ---------------------------------------------------------------------------------

_VOCAB = f"""
concept AS ({M.CONCEPT_SQL}),
relationship AS ({M.RELATIONSHIP_SQL}),
std AS (
  SELECT DISTINCT a.concept_code AS code, a.vocabulary_id AS svoc, a.domain_id AS sdom, a.concept_id AS sid,
         b.concept_id AS std, b.domain_id AS dom, b.vocabulary_id AS voc
  FROM relationship r JOIN concept a ON a.concept_id = r.concept_id_1 JOIN concept b ON b.concept_id = r.concept_id_2
  WHERE r.relationship_id = 'Maps to' AND r.invalid_reason IS NULL AND b.invalid_reason IS NULL
    AND b.standard_concept = 'S'),
src AS (SELECT concept_code AS code, concept_id AS src, vocabulary_id AS voc, domain_id AS dom FROM concept)"""
_CONTEXT = f"""
known AS (SELECT id AS patient, {hk('id')} AS person_id FROM patients WHERE gender IS NOT NULL),
ctx AS (
  SELECT e.id AS encounter, e.patient AS epatient, f.visit_occurrence_id_new AS visit,
         CASE WHEN p.id IS NOT NULL THEN {hk('e.provider')} END AS provider
  FROM encounters e LEFT JOIN providers p ON p.id = e.provider LEFT JOIN final f ON f.encounter_id = e.id)"""
_CODED = with_(E, C.ctes("patients", "providers"), VISITS, _CONTEXT, _VOCAB)
_PLACE = (
    "person_id, CASE WHEN epatient = r.patient THEN provider END AS provider_id, visit AS visit_occurrence_id, "
    "visit + 1000000 AS visit_detail_id"
)
_IN = "JOIN known USING (patient) LEFT JOIN ctx USING (encounter)"
_WHERE = "person_id provider_id visit_occurrence_id visit_detail_id"


def coded(*sources: str) -> str:
    return _CODED.rstrip() + ",\n" + C.ctes(*sources) + "\n"


_CONDITION = f"""
SELECT {_PLACE}, s.std AS condition_concept_id, r.start AS condition_start_date, r.stop AS condition_end_date,
       r.code AS condition_source_value, src.src AS condition_source_concept_id
FROM conditions r JOIN std s ON s.code = r.code AND s.dom = 'Condition' AND s.voc = 'SNOMED'
  AND s.svoc IN ('SNOMED', 'ICD10CM')
JOIN src ON src.code = r.code AND src.voc IN ('SNOMED', 'ICD10CM') {_IN}"""
register(
    "csv_condition_occurrence",
    from_sources(
        P.condition_occurrence,
        _WHERE + " condition_concept_id condition_start_date condition_end_date condition_source_value "
        "condition_source_concept_id",
    ),
    coded("conditions") + _CONDITION,
)
_DRUG = f"""
SELECT {_PLACE}, s.std AS drug_concept_id, r.start AS drug_exposure_start_date,
       coalesce(r.stop, r.start) AS drug_exposure_end_date, r.stop AS verbatim_end_date, 32838 AS drug_type_concept_id,
       CAST(coalesce(r.stop - r.start, 0) AS INT) AS days_supply, r.code AS drug_source_value,
       src.src AS drug_source_concept_id
FROM medications r JOIN std s ON s.code = r.code AND s.dom = 'Drug' AND s.voc = 'RxNorm'
JOIN src ON src.code = r.code AND src.voc = 'RxNorm' {_IN}
UNION ALL
SELECT {_PLACE}, s.std, r.date, r.date, r.date, 32827, 0, r.code, src.src
FROM immunizations r JOIN std s ON s.code = r.code AND s.dom = 'Drug' AND s.voc = 'CVX'
JOIN src ON src.code = r.code AND src.voc = 'CVX' {_IN}"""
register(
    "csv_drug_exposure",
    from_sources(
        P.drug_exposure,
        _WHERE + " drug_concept_id drug_exposure_start_date drug_exposure_end_date verbatim_end_date "
        "drug_type_concept_id days_supply drug_source_value drug_source_concept_id",
    ),
    coded("medications", "immunizations") + _DRUG,
)
register(
    "csv_measurement",
    from_sources(
        P.measurement,
        _WHERE + " measurement_concept_id measurement_date value_as_number value_as_concept_id unit_concept_id "
        "measurement_source_value measurement_source_concept_id unit_source_value value_source_value",
    ),
    coded("procedures", "observations")
    + f"""
SELECT {_PLACE}, s.std AS measurement_concept_id, r.start AS measurement_date,
       CAST(NULL AS DOUBLE) AS value_as_number, 0 AS value_as_concept_id, 0 AS unit_concept_id,
       r.code AS measurement_source_value, src.src AS measurement_source_concept_id,
       CAST(NULL AS VARCHAR) AS unit_source_value, CAST(NULL AS VARCHAR) AS value_source_value
FROM procedures r JOIN std s ON s.code = r.code AND s.dom = 'Measurement' AND s.svoc = 'SNOMED'
JOIN src ON src.code = r.code AND src.voc = 'SNOMED' {_IN}
UNION ALL
SELECT {_PLACE}, s.std, r.date, TRY_CAST(r.value AS DOUBLE), coalesce(answer.std, 0), coalesce(unit.concept_id, 0),
       left(r.value, 50), coalesce(src.src, 0), r.units, r.value
FROM observations r JOIN std s ON s.code = r.code AND s.dom = 'Measurement' AND s.svoc = 'LOINC'
LEFT JOIN src ON src.code = r.code AND src.voc = 'LOINC'
LEFT JOIN (SELECT u.concept_code, u.concept_id FROM concept u
           WHERE u.vocabulary_id = 'UCUM' AND u.concept_id IN (SELECT concept_id_1 FROM relationship)) unit
  ON unit.concept_code = r.units
LEFT JOIN std answer ON answer.code = r.value AND answer.dom = 'Meas value' {_IN}""",
)
register(
    "csv_observation",
    from_sources(
        P.observation,
        "observation_id " + _WHERE + " observation_concept_id observation_date observation_type_concept_id "
        "observation_source_value observation_source_concept_id",
    ),
    coded("allergies", "conditions", "observations")
    + "\nUNION ALL\n".join(
        f"""
SELECT {hk(key)} AS observation_id, {_PLACE}, s.std AS observation_concept_id, r.{day} AS observation_date,
       {kind} AS observation_type_concept_id, {text} AS observation_source_value,
       src.src AS observation_source_concept_id
FROM {source} r JOIN std s ON s.code = r.code AND s.dom = 'Observation' AND s.voc = '{voc}'
JOIN src ON src.code = r.code AND src.voc = '{voc}' AND src.dom = 'Observation' {_IN}"""
        for source, day, kind, text, voc, key in (
            ("allergies", "start", 32827, "r.code", "SNOMED", "'a:' || r.patient || '|' || r.code || '|' || r.start"),
            ("conditions", "start", 38000280, "r.code", "SNOMED", "'c:' || r.patient || '|' || r.code || '|' || r.start"),
            (
                "observations",
                "date",
                38000280,
                "left(r.value, 50)",
                "LOINC",
                "'o:' || r.patient || '|' || r.code || '|' || r.date || '|' || coalesce(left(r.value, 50), '')",
            ),
        )
    ),
)
_PROCEDURE = f"""
SELECT {_PLACE}, s.std AS procedure_concept_id, r.start AS procedure_date, r.stop AS procedure_end_date,
       r.code AS procedure_source_value, src.src AS procedure_source_concept_id
FROM procedures r JOIN std s ON s.code = r.code AND s.dom = 'Procedure' AND s.voc = 'SNOMED'
  AND s.svoc IN ('SNOMED', 'HCPCS')
JOIN src ON src.code = r.code AND src.voc IN ('SNOMED', 'HCPCS') {_IN}"""
register(
    "csv_procedure_occurrence",
    from_sources(
        P.procedure_occurrence,
        _WHERE + " procedure_concept_id procedure_date procedure_end_date procedure_source_value "
        "procedure_source_concept_id",
    ),
    coded("procedures") + _PROCEDURE,
)
register(
    "csv_device_exposure",
    from_sources(
        P.device_exposure,
        _WHERE + " device_concept_id device_exposure_start_date unique_device_id device_source_value "
        "device_source_concept_id",
    ),
    coded("devices")
    + f"""
SELECT {_PLACE}, s.std AS device_concept_id, r.start AS device_exposure_start_date, r.udi AS unique_device_id,
       r.code AS device_source_value, src.src AS device_source_concept_id
FROM devices r JOIN std s ON s.code = r.code AND s.dom = 'Device' AND s.voc = 'SNOMED' AND s.svoc = 'SNOMED'
JOIN src ON src.code = r.code AND src.voc = 'SNOMED' {_IN}""",
)

# --- people and places ----------------------------------------------------------------------------

_STATE = "CASE state WHEN 'Texas' THEN 'TX' WHEN 'Ohio' THEN 'OH' END"
register(
    "csv_location",
    from_sources(P.location, "location_id city state zip location_source_value"),
    with_(C.ctes("patients"))
    + f"SELECT DISTINCT {hk('zip')} AS location_id, city, {_STATE} AS state, zip, zip AS location_source_value FROM patients",
)
register(
    "csv_person",
    from_sources(
        P.person,
        "person_id gender_concept_id year_of_birth month_of_birth day_of_birth race_concept_id ethnicity_concept_id "
        "location_id person_source_value gender_source_value race_source_value ethnicity_source_value",
    ),
    with_(C.ctes("patients"))
    + f"""
SELECT {hk('id')} AS person_id, CASE upper(gender) WHEN 'M' THEN 8507 ELSE 8532 END AS gender_concept_id,
       CAST(year(birthdate) AS INT) AS year_of_birth, CAST(month(birthdate) AS INT) AS month_of_birth,
       CAST(day(birthdate) AS INT) AS day_of_birth,
       CASE race WHEN 'white' THEN 8527 WHEN 'black' THEN 8516 WHEN 'asian' THEN 8515 ELSE 0 END AS race_concept_id,
       CASE ethnicity WHEN 'hispanic' THEN 38003563 WHEN 'nonhispanic' THEN 38003564 ELSE 0 END AS ethnicity_concept_id,
       CASE WHEN {_STATE} IS NOT NULL THEN {hk('zip')} END AS location_id, id AS person_source_value,
       gender AS gender_source_value, race AS race_source_value, ethnicity AS ethnicity_source_value
FROM patients WHERE gender IS NOT NULL""",
)
register(
    "csv_care_site",
    from_sources(P.care_site, "care_site_id care_site_name care_site_source_value"),
    with_(C.ctes("organizations"))
    + f"SELECT {hk('id')} AS care_site_id, name AS care_site_name, id AS care_site_source_value FROM organizations",
)
register(
    "csv_provider",
    from_sources(P.provider, "provider_id provider_name gender_concept_id provider_source_value specialty_source_value"),
    with_(C.ctes("providers"))
    + f"""
SELECT {hk('id')} AS provider_id, name AS provider_name,
       CASE gender WHEN 'M' THEN 8507 WHEN 'F' THEN 8532 END AS gender_concept_id, id AS provider_source_value,
       speciality AS specialty_source_value FROM providers""",
)
_KNOWN = f"known AS (SELECT id AS patient, {hk('id')} AS person_id FROM patients WHERE gender IS NOT NULL)"
register(
    "csv_death",
    from_sources(P.death, "person_id death_date cause_concept_id cause_source_value cause_source_concept_id"),
    with_(C.ctes("patients", "encounters"), _KNOWN, _VOCAB)
    + """
SELECT person_id, start AS death_date, s.std AS cause_concept_id, reasoncode AS cause_source_value,
       s.sid AS cause_source_concept_id
FROM encounters e JOIN known USING (patient)
JOIN std s ON s.code = e.reasoncode AND s.dom = 'Condition' AND s.sdom = 'Condition' AND s.voc = 'SNOMED' AND s.svoc = 'SNOMED'
WHERE e.code = '308646001'""",
)
register(
    "csv_observation_period",
    from_sources(
        P.observation_period, "person_id observation_period_start_date observation_period_end_date period_type_concept_id"
    ),
    with_(C.ctes("patients", "encounters"), _KNOWN)
    + """
SELECT person_id, min(start) AS observation_period_start_date, max(stop) AS observation_period_end_date,
       32882 AS period_type_concept_id FROM encounters JOIN known USING (patient) GROUP BY person_id""",
)
_PLAN = f"""
plans AS (
  SELECT {hk("t.patient || '|' || t.payer || '|' || t.start_date || '|' || t.end_date")} AS payer_plan_period_id,
         person_id, start_date, end_date, t.payer, p.name
  FROM payer_transitions t JOIN known USING (patient) JOIN payers p ON p.id = t.payer)"""
register(
    "csv_payer_plan_period",
    from_sources(
        P.payer_plan_period,
        "payer_plan_period_id person_id payer_plan_period_start_date payer_plan_period_end_date payer_source_value "
        "plan_source_value",
    ),
    with_(C.ctes("patients", "payers", "payer_transitions"), _KNOWN, _PLAN)
    + "SELECT payer_plan_period_id, person_id, start_date AS payer_plan_period_start_date, "
    "end_date AS payer_plan_period_end_date, payer AS payer_source_value, name AS plan_source_value FROM plans",
)

# --- cost -----------------------------------------------------------------------------------------


def _cost(src: P.Sources) -> DataFrame:
    """Costs without surrogate row keys of the events, which the oracle side restates by their facts."""
    tables = (
        P.visit_occurrence(src),
        P.procedure_occurrence(src),
        P.drug_exposure(src),
        P.condition_occurrence(src),
        P.payer_plan_period(src),
    )
    # The tables a load has written by then; here the checkpoint folder stands in for them.
    return P.cost(src, *[checkpointed(t) for t in tables]).select(
        "cost_domain_id",
        "cost_event_id",
        "payer_plan_period_id",
        "total_charge",
        "total_paid",
        "paid_by_payer",
        "paid_by_patient",
        "paid_by_primary",
    )


def _key(*parts: str) -> str:
    return hk(" || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts))


_PO = _key("r.patient", "r.encounter", "r.code", "r.start", "r.stop", "s.std", "src.src")
_DE_M = _key("32838", "r.patient", "r.encounter", "r.code", "r.start", "r.stop", "s.std", "src.src")
_DE_I = _key("32827", "r.patient", "r.encounter", "r.code", "r.date", "r.date", "s.std", "src.src")


def _priced(name: str, source: str, events: str, domain: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT '{domain}' AS cost_domain_id, ev.eid AS cost_event_id, pl.payer_plan_period_id,
         e.total_claim_cost + x.base_cost AS total_charge, e.payer_coverage + x.base_cost AS total_paid,
         e.payer_coverage AS paid_by_payer, e.total_claim_cost + x.base_cost - e.payer_coverage AS paid_by_patient,
         CAST(NULL AS DOUBLE) AS paid_by_primary
  FROM (SELECT DISTINCT patient, encounter, code, base_cost FROM {source}) x
  JOIN encounters e ON e.id = x.encounter AND e.patient = x.patient
  JOIN visit_rows v ON v.encounter_id = e.id AND v.patient = x.patient
  JOIN {events} ev ON ev.code = x.code AND ev.visit = v.visit_occurrence_id AND ev.person_id = v.person_id
  LEFT JOIN plans pl ON pl.person_id = v.person_id AND ev.day BETWEEN pl.start_date AND pl.end_date)"""


_COST_SQL = (
    with_(
        C.ctes(
            "encounters",
            "patients",
            "providers",
            "organizations",
            "payers",
            "payer_transitions",
            "procedures",
            "medications",
            "immunizations",
            "conditions",
            "claims",
            "claims_transactions",
        ),
        VISITS,
        _VISIT_ROWS,
        _PLAN,
        _CONTEXT.split("\n", 2)[2],
        _VOCAB,
        f"""
po AS (
  SELECT DISTINCT {_PO} AS eid, r.code, person_id, visit, r.start AS day
  FROM procedures r JOIN std s ON s.code = r.code AND s.dom = 'Procedure' AND s.voc = 'SNOMED' AND s.svoc = 'SNOMED'
  JOIN src ON src.code = r.code AND src.voc = 'SNOMED' {_IN}),
de AS (
  SELECT DISTINCT {_DE_M} AS eid, r.code, person_id, visit, r.start AS day
  FROM medications r JOIN std s ON s.code = r.code AND s.dom = 'Drug' AND s.voc = 'RxNorm'
  JOIN src ON src.code = r.code AND src.voc = 'RxNorm' {_IN}
  UNION ALL
  SELECT DISTINCT {_DE_I}, r.code, person_id, visit, r.date
  FROM immunizations r JOIN std s ON s.code = r.code AND s.dom = 'Drug' AND s.voc = 'CVX'
  JOIN src ON src.code = r.code AND src.voc = 'CVX' {_IN}),
co AS (
  SELECT DISTINCT {_PO} AS eid, r.code, person_id, visit, r.start AS day
  FROM conditions r JOIN std s ON s.code = r.code AND s.dom = 'Condition' AND s.voc = 'SNOMED'
    AND s.svoc IN ('SNOMED', 'ICD10CM')
  JOIN src ON src.code = r.code AND src.voc IN ('SNOMED', 'ICD10CM') {_IN})""",
        _priced("cost_p", "procedures", "po", "Procedure"),
        _priced("cost_i", "immunizations", "de", "Drug"),
        _priced("cost_m", "medications", "de", "Drug"),
        """
cost_c AS (
  SELECT 'Condition' AS cost_domain_id, eid AS cost_event_id, payer_plan_period_id, payer + patient AS total_charge,
         payer + patient AS total_paid, payer AS paid_by_payer, patient AS paid_by_patient, payer AS paid_by_primary
  FROM (
    SELECT ev.eid, pl.payer_plan_period_id,
           coalesce(sum(CASE WHEN ct.transfertype = '1' THEN ct.amount END), 0) AS payer,
           coalesce(sum(CASE WHEN ct.transfertype = 'p' THEN ct.amount END), 0) AS patient
    FROM conditions cn JOIN encounters e ON e.id = cn.encounter AND e.patient = cn.patient
    JOIN visit_rows v ON v.encounter_id = e.id AND v.patient = cn.patient
    JOIN co ev ON ev.code = cn.code AND ev.visit = v.visit_occurrence_id AND ev.person_id = v.person_id
    LEFT JOIN plans pl ON pl.person_id = v.person_id AND ev.day BETWEEN pl.start_date AND pl.end_date
    JOIN claims ca ON ca.patientid = cn.patient AND ca.diagnosis1 = cn.code AND ca.currentillnessdate = cn.start
      AND ca.appointmentid = e.id AND ca.providerid = e.provider AND ca.primarypatientinsuranceid = e.payer
      AND ca.servicedate = e.start
    JOIN claims_transactions ct ON ct.claimid = ca.id AND ct.patientid = cn.patient AND ct.appointmentid = e.id
      AND ct.providerid = e.provider
    WHERE ct.transfertype IN ('1', 'p')
    GROUP BY ev.eid, pl.payer_plan_period_id))""",
    )
    + """
SELECT cost_domain_id, cost_event_id, payer_plan_period_id, CAST(total_charge AS DOUBLE) AS total_charge,
       CAST(total_paid AS DOUBLE) AS total_paid, CAST(paid_by_payer AS DOUBLE) AS paid_by_payer,
       CAST(paid_by_patient AS DOUBLE) AS paid_by_patient, CAST(paid_by_primary AS DOUBLE) AS paid_by_primary
FROM (SELECT * FROM cost_p UNION ALL SELECT * FROM cost_i UNION ALL SELECT * FROM cost_m UNION ALL SELECT * FROM cost_c)"""
)
register("csv_cost", from_sources(_cost, materialize=True, stored=True), _COST_SQL)
