"""Registered queries of the FHIR path: every view family, edge and resolver over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import mirror as M
from medloom.operators import terminology as V
from medloom.operators.flatten import flatten
from medloom.plans import edges as E
from medloom.plans import views

Build = Callable[[SparkSession, str], DataFrame]


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand over the same type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )


def context(spark: SparkSession, sf_dir: str, *types: str) -> E.Context:
    return E.Context(M.resources(spark, sf_dir, *types), M.vocabulary(spark, sf_dir))


def edge(build: Callable[[E.Context], DataFrame], columns: str, *types: str) -> Build:
    return lambda spark, sf_dir: doubles(build(context(spark, sf_dir, *types)).select(*columns.split()))


def view(v: views.View, columns: str) -> Build:
    return lambda spark, sf_dir: doubles(
        flatten(M.resources(spark, sf_dir, v.resource), v).select(*columns.split())
    )


# --- oracle text ----------------------------------------------------------------------------------


def hk(expr: str) -> str:
    return f"CASE WHEN ({expr}) <> '' THEN CAST('0x' || substr(md5({expr}), 1, 15) AS BIGINT) END"


WITH_MAPS = f"""
concept AS ({M.CONCEPT_SQL}),
relationship AS ({M.RELATIONSHIP_SQL}),
maps AS (
  SELECT s.vocabulary_id AS vocab, s.concept_code AS code, s.concept_id AS src, t.concept_id AS std, t.domain_id AS dom
  FROM relationship r, concept s, concept t
  WHERE r.relationship_id = 'Maps to' AND r.invalid_reason IS NULL
    AND s.concept_id = r.concept_id_1 AND t.concept_id = r.concept_id_2 AND t.standard_concept = 'S'
)"""

LINE = f"""
line AS (
  SELECT *, {M.LINE_ID} AS lid, strftime(l_shipdate, '%Y-%m-%d') AS day_text, CAST(l_shipdate AS DATE) AS day,
         {M.BASE} AS base,
         {hk("'p' || (l_orderkey % 997)")} AS person_id, {hk("'e' || l_orderkey")} AS visit_occurrence_id,
         {hk("'s' || l_suppkey")} AS supplier_key
  FROM lineitem
)"""

# Both codings of a line, and for each its standard concepts, one row per standard concept.
BOTH = f"""
codes AS (
  SELECT DISTINCT lid, pk, shown FROM (
    SELECT lid, l_partkey AS pk, CASE WHEN l_partkey % 3 = 0 THEN 'D' || l_partkey END AS shown FROM line
    UNION ALL SELECT lid, {M.SECOND}, NULL FROM line)
)"""


def ranked(prefer: list[str]) -> str:
    rank = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(prefer, 1))
    return f"""
hits AS (
  SELECT * FROM (
    SELECT c.lid, c.shown, 'C' || c.pk AS code_value, m.src, m.std, m.dom,
           row_number() OVER (PARTITION BY c.lid, m.std
             ORDER BY CASE m.vocab {rank} ELSE 9 END, m.src, 'C' || c.pk, c.shown NULLS LAST) AS rn
    FROM codes c JOIN maps m ON m.vocab = {M.vocabulary_of('c.pk')} AND m.code = 'C' || c.pk)
  WHERE rn = 1
)"""


CONDITION_HITS = ranked(["SNOMED", "ICD10CM", "ICD9CM", "ICD10"])
LOINC_HITS = ranked(["LOINC", "SNOMED"])


def best(alias: str, domain: str | None) -> str:
    where = f"WHERE dom = '{domain}'" if domain else ""
    return (
        f"{alias} AS (SELECT vocab, code, min(std) AS std, arg_min(src, CAST(std AS BIGINT) * 1000000000 + src) AS src "
        f"FROM maps {where} GROUP BY vocab, code)"
    )


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


Q: dict[str, Build] = {}
SQL: dict[str, str] = {}


def register(name: str, build: Build, sql: str | None = None) -> None:
    Q[name] = build
    if sql is not None:
        SQL[name] = sql


# --- Condition ------------------------------------------------------------------------------------

_CONDITION_DAY = "CASE l_returnflag WHEN 'A' THEN day WHEN 'N' THEN day ELSE DATE '1999-09-09' END"
_CONDITION_TIME = (
    "CASE l_returnflag WHEN 'A' THEN CAST(day AS TIMESTAMP) + INTERVAL 1410 MINUTE "
    "WHEN 'N' THEN CAST(day AS TIMESTAMP) ELSE TIMESTAMP '1999-09-09 00:00:00' END"
)
_CONDITION_FROM = (
    "FROM line JOIN hits USING (lid) WHERE dom = '{domain}' AND l_linenumber NOT IN (1, 4)"
)


def _condition_sql(domain: str, prefix: str, date: str, extra: str) -> str:
    return with_(WITH_MAPS, LINE, BOTH, CONDITION_HITS) + f"""
SELECT {hk("'c-' || lid || '|' || std")} AS {prefix}_id, person_id,
       {hk("CASE WHEN l_linenumber % 2 = 0 THEN 'a' || l_suppkey ELSE 's' || l_suppkey END")} AS provider_id,
       visit_occurrence_id, {_CONDITION_DAY} AS {date}_date, {_CONDITION_TIME} AS {date}_datetime,
       src AS {prefix.split('_')[0]}_source_concept_id, std AS {prefix.split('_')[0]}_concept_id,
       left(coalesce(shown, code_value), 50) AS {prefix.split('_')[0]}_source_value{extra}
{_CONDITION_FROM.format(domain=domain)}"""


register(
    "edge_condition_occurrence",
    edge(
        E.condition_occurrence,
        "condition_occurrence_id person_id provider_id visit_occurrence_id condition_start_date "
        "condition_start_datetime condition_source_concept_id condition_concept_id condition_source_value "
        "condition_end_date condition_end_datetime condition_type_concept_id condition_status_concept_id "
        "stop_reason condition_status_source_value",
        "Condition",
    ),
    _condition_sql(
        "Condition",
        "condition_occurrence",
        "condition_start",
        """,
       CASE WHEN l_linestatus = 'F' THEN day END AS condition_end_date,
       CASE WHEN l_linestatus = 'F' THEN CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR END AS condition_end_datetime,
       CASE l_returnflag WHEN 'A' THEN 32827 WHEN 'N' THEN 32840 ELSE 32817 END AS condition_type_concept_id,
       CASE WHEN l_linenumber = 2 THEN 32899 WHEN l_linenumber >= 6 THEN 32893
            WHEN l_linestatus = 'F' THEN 32906 ELSE 0 END AS condition_status_concept_id,
       'a string of more tha' AS stop_reason,
       CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'resolved' END AS condition_status_source_value""",
    ),
)
for _domain, _prefix, _date, _fn in (
    ("Procedure", "procedure_occurrence", "procedure", E.condition_procedure),
    ("Measurement", "measurement", "measurement", E.condition_measurement),
    ("Observation", "observation", "observation", E.condition_observation),
):
    _p = _prefix.split("_")[0]
    register(
        f"edge_condition_{_p}",
        edge(
            _fn,
            f"{_prefix}_id person_id provider_id visit_occurrence_id {_date}_date {_date}_datetime "
            f"{_p}_source_concept_id {_p}_concept_id {_p}_source_value {_p}_type_concept_id",
            "Condition",
        ),
        _condition_sql(_domain, _prefix, _date, f", 32827 AS {_p}_type_concept_id"),
    )

register(
    "resolve_condition",
    lambda spark, sf_dir: context(spark, sf_dir, "Condition")
    .family("condition", columns=("id", "code_value", "code_display"))
    .select("id", "code_value", "code_display", "src_concept_id", "std_concept_id", "std_domain"),
    with_(WITH_MAPS, LINE, BOTH, CONDITION_HITS)
    + "SELECT 'c-' || lid AS id, code_value, shown AS code_display, src AS src_concept_id, std AS std_concept_id, "
    "dom AS std_domain FROM hits",
)
register(
    "route_domains",
    lambda spark, sf_dir: context(spark, sf_dir, "Condition")
    .family("condition", columns=("id",))
    .groupBy("std_domain")
    .agg(F.count("*").alias("n"), F.countDistinct("std_concept_id").alias("concepts")),
    with_(WITH_MAPS, LINE, BOTH, CONDITION_HITS)
    + "SELECT dom AS std_domain, count(*) AS n, count(DISTINCT std) AS concepts FROM hits GROUP BY dom",
)
register(
    "unrouted_rows",
    lambda spark, sf_dir: V.unrouted(
        context(spark, sf_dir, "Condition").family("condition", columns=("id",)),
        ["Condition", "Procedure", "Measurement", "Observation"],
    ).select("id", "std_concept_id", "std_domain"),
    with_(WITH_MAPS, LINE, BOTH, CONDITION_HITS)
    + "SELECT 'c-' || lid AS id, std AS std_concept_id, dom AS std_domain FROM hits "
    "WHERE dom NOT IN ('Condition', 'Procedure', 'Measurement', 'Observation')",
)
_ROUTES = ("Condition", "Procedure", "Measurement", "Observation")
register(
    "family_route_counts",
    lambda spark, sf_dir: V.route_counts(context(spark, sf_dir, "Condition").family("condition", columns=("id",)), _ROUTES),
    with_(WITH_MAPS, LINE, BOTH, CONDITION_HITS)
    + "SELECT r.route, count(h.dom) AS n, count(DISTINCT h.lid || '|' || h.std) AS row_keys "
    "FROM (SELECT unnest(['Condition', 'Procedure', 'Measurement', 'Observation', 'unrouted']) AS route) r LEFT JOIN hits h "
    "ON CASE WHEN h.dom IN ('Condition', 'Procedure', 'Measurement', 'Observation') THEN h.dom ELSE 'unrouted' END = r.route "
    "GROUP BY r.route",
)
register(
    "view_condition",
    view(
        views.condition,
        "id subject_ref encounter_ref recorder_ref asserter_ref code_system code_value code_display category_code "
        "onset_dt onset_period_start abatement_dt clinical_status_code verification_status_code",
    ),
    with_(LINE, BOTH)
    + f"""
SELECT 'c-' || lid AS id, 'p' || (l_orderkey % 997) AS subject_ref, 'e' || l_orderkey AS encounter_ref,
       's' || l_suppkey AS recorder_ref, CASE WHEN l_linenumber % 2 = 0 THEN 'a' || l_suppkey END AS asserter_ref,
       {M.system_of('pk')} AS code_system, 'C' || pk AS code_value, shown AS code_display,
       CASE l_returnflag WHEN 'A' THEN 'encounter-diagnosis' WHEN 'N' THEN 'problem-list-item' ELSE 'other' END
         AS category_code,
       CASE WHEN l_returnflag = 'A' THEN day_text || 'T23:30:00-05:00' END AS onset_dt,
       CASE WHEN l_returnflag = 'N' THEN day_text END AS onset_period_start,
       CASE WHEN l_linestatus = 'F' THEN day_text || 'T01:00:00Z' END AS abatement_dt,
       CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'resolved' END AS clinical_status_code,
       CASE l_linenumber WHEN 1 THEN 'refuted' WHEN 2 THEN 'provisional' WHEN 3 THEN NULL
         WHEN 4 THEN 'entered-in-error' WHEN 5 THEN 'unconfirmed' ELSE 'confirmed' END AS verification_status_code
FROM line JOIN codes USING (lid)""",
)

# --- DiagnosticReport -----------------------------------------------------------------------------

for _domain, _prefix, _fn, _type, _more in (
    ("Measurement", "measurement", E.report_measurement, 32856, ""),
    ("Observation", "observation", E.report_observation, 32817, ", 'free text' AS value_source_value"),
    ("Procedure", "procedure_occurrence", E.report_procedure, 32827, ""),
):
    _p = _prefix.split("_")[0]
    register(
        f"edge_report_{_p}",
        edge(
            _fn,
            f"{_prefix}_id person_id provider_id visit_occurrence_id {_p}_date {_p}_datetime {_p}_type_concept_id "
            f"{_p}_concept_id {_p}_source_concept_id {_p}_source_value" + (" value_source_value" if _more else ""),
            "DiagnosticReport",
        ),
        with_(WITH_MAPS, LINE, BOTH, LOINC_HITS)
        + f"""
SELECT {hk("'r-' || lid || '|' || std")} AS {_prefix}_id, person_id, supplier_key AS provider_id,
       visit_occurrence_id, day AS {_p}_date, CAST(day AS TIMESTAMP) + INTERVAL 615 MINUTE AS {_p}_datetime,
       {_type} AS {_p}_type_concept_id, std AS {_p}_concept_id, src AS {_p}_source_concept_id,
       code_value AS {_p}_source_value{_more}
FROM line JOIN hits USING (lid) WHERE dom = '{_domain}' AND l_linenumber <> 1""",
    )

register(
    "edge_report_note",
    lambda spark, sf_dir: E.report_note(
        E.Context(M.note_resources(spark, sf_dir), M.vocabulary(spark, sf_dir))
    ).select(
        "note_id",
        "person_id",
        "note_date",
        "note_datetime",
        "note_class_concept_id",
        "note_title",
        "note_text",
        "provider_id",
        "note_source_value",
    ),
    with_(WITH_MAPS, best("b", None))
    + f"""
SELECT {hk("'n' || doc_id")} AS note_id, {hk("'p' || (doc_id % 997)")} AS person_id, DATE '2021-03-04' AS note_date,
       TIMESTAMP '2021-03-04 05:06:07' AS note_datetime, coalesce(b.std, 0) AS note_class_concept_id,
       'title ' || source AS note_title,
       CASE WHEN doc_id % 3 <> 0 THEN text WHEN doc_id % 2 = 0 THEN 'concluded ' || lang ELSE 'title ' || source END
         AS note_text,
       {hk("'s' || (doc_id % 10)")} AS provider_id, 'C' || ((doc_id % 20) * 10 + 1) AS note_source_value
FROM documents LEFT JOIN b ON b.vocab = 'LOINC' AND b.code = 'C' || ((doc_id % 20) * 10 + 1)
WHERE doc_id % 13 <> 0 AND doc_id % 11 <> 0""",
)

# --- Observation ----------------------------------------------------------------------------------

_EVENT = f"""
ev AS (
  SELECT *, 'o' || event_id AS oid, {hk("'p' || user_id")} AS person_id, {hk("'e' || (event_id % 1000)")} AS visit,
         {hk("'s' || (user_id % 10)")} AS provider_id, CAST(ts AS DATE) AS day,
         CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS at_time,
         event_type IN ('click', 'view', 'error') AS numeric_kind,
         CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'cancelled' ELSE 'final' END AS state
  FROM events
)"""
_EVENT_CODES = """
codes AS (
  SELECT DISTINCT oid AS lid, pk, CAST(NULL AS VARCHAR) AS shown FROM (
    SELECT oid, event_id % 200 AS pk FROM ev UNION ALL SELECT oid, (event_id * 3 + 1) % 200 FROM ev)
)"""
_ANSWER = f"LEFT JOIN b ON event_type = 'purchase' AND b.vocab = {M.vocabulary_of('user_id % 200')} AND b.code = 'C' || (user_id % 200)"
_UNIT = "LEFT JOIN nation u ON numeric_kind AND u.n_name = 'NATION_' || (user_id % 30)"
_SIGN = "CASE event_id % 6 WHEN 0 THEN 4171756 WHEN 1 THEN 4171754 WHEN 2 THEN 4171755 WHEN 3 THEN 4172704 END"
_OBSERVATION_SQL = with_(WITH_MAPS, _EVENT, _EVENT_CODES, LOINC_HITS, best("b", None)) + """
SELECT {key} AS {p}_id, person_id, std AS {p}_concept_id, day AS {p}_date, at_time AS {p}_datetime,
       CASE WHEN numeric_kind THEN value END AS value_as_number, b.std AS value_as_concept_id,
       CAST(900000000 + u.n_nationkey AS INT) AS unit_concept_id, provider_id, visit AS visit_occurrence_id,
       code_value AS {p}_source_value, hits.src AS {p}_source_concept_id,
       CASE WHEN numeric_kind THEN 'unit ' || (user_id % 30) END AS unit_source_value,
       CASE WHEN event_type = 'purchase' THEN 'answer ' || user_id END AS value_source_value{extra}
FROM ev JOIN hits ON hits.lid = oid {answer} {unit}
WHERE dom = '{domain}' AND state <> 'cancelled' AND NOT (event_type = 'signup' AND event_id % 4 = 0)"""


def _observation_sql(domain: str, p: str, extra: str) -> str:
    text = _OBSERVATION_SQL
    for mark, value in {
        "{key}": hk("oid || '|' || hits.std"),
        "{p}": p,
        "{extra}": extra,
        "{answer}": _ANSWER,
        "{unit}": _UNIT,
        "{domain}": domain,
        " std AS": " hits.std AS",
    }.items():
        text = text.replace(mark, value)
    return text


_OBS_COLS = (
    "{p}_id person_id {p}_concept_id {p}_date {p}_datetime value_as_number value_as_concept_id unit_concept_id "
    "provider_id visit_occurrence_id {p}_source_value {p}_source_concept_id unit_source_value value_source_value"
)
register(
    "edge_observation_measurement",
    edge(
        E.observation_measurement,
        _OBS_COLS.replace("{p}", "measurement") + " operator_concept_id range_low range_high",
        "Observation",
    ),
    _observation_sql(
        "Measurement",
        "measurement",
        f""", CASE WHEN numeric_kind THEN {_SIGN} END AS operator_concept_id,
       CASE WHEN event_id % 2 = 0 THEN value - 1 END AS range_low,
       CASE WHEN event_id % 2 = 0 THEN value * 2 END AS range_high""",
    ),
)
register(
    "edge_observation_observation",
    edge(
        E.observation_observation,
        _OBS_COLS.replace("{p}", "observation") + " value_as_string qualifier_source_value",
        "Observation",
    ),
    _observation_sql(
        "Observation",
        "observation",
        """, CASE WHEN event_type = 'signup' THEN 'text ' || event_id END AS value_as_string,
       CASE WHEN value > 50 THEN 'H' END AS qualifier_source_value""",
    ),
)
_PARTS = """
parts AS (
  SELECT *, (event_id + 1) % 200 AS pk, 1 AS part FROM ev WHERE event_id % 3 <> 2
  UNION ALL SELECT *, (event_id + 2) % 200, 2 FROM ev WHERE event_id % 3 <> 2
)"""
_PART_FROM = f"""
FROM parts JOIN maps m ON m.vocab = {M.vocabulary_of('pk')} AND m.code = 'C' || pk
LEFT JOIN nation u ON part = 1 AND u.n_name = 'NATION_' || (user_id % 30)
LEFT JOIN b ON part = 2 AND event_id % 2 = 0 AND b.vocab = {M.vocabulary_of('user_id % 200')}
           AND b.code = 'C' || (user_id % 200)
WHERE state <> 'cancelled' AND m.dom = """
register(
    "edge_component_measurement",
    edge(
        E.component_measurement,
        "measurement_id person_id measurement_concept_id measurement_date measurement_datetime value_as_number "
        "unit_concept_id provider_id visit_occurrence_id measurement_source_value measurement_source_concept_id "
        "unit_source_value",
        "Observation",
    ),
    with_(WITH_MAPS, _EVENT, _PARTS, best("b", None))
    + f"""
SELECT {hk("oid || '/C' || pk || '|' || m.std")} AS measurement_id, person_id, m.std AS measurement_concept_id,
       day AS measurement_date, at_time AS measurement_datetime, value AS value_as_number,
       CAST(900000000 + u.n_nationkey AS INT) AS unit_concept_id, provider_id, visit AS visit_occurrence_id,
       'C' || pk AS measurement_source_value, m.src AS measurement_source_concept_id, 'u' AS unit_source_value
{_PART_FROM} 'Measurement' AND part = 1""",
)
register(
    "edge_component_observation",
    edge(
        E.component_observation,
        "observation_id person_id observation_concept_id observation_date value_as_number value_as_string "
        "value_as_concept_id unit_concept_id observation_source_value observation_source_concept_id "
        "unit_source_value value_source_value",
        "Observation",
    ),
    with_(WITH_MAPS, _EVENT, _PARTS, best("b", None))
    + f"""
SELECT {hk("oid || '/o/C' || pk || '|' || m.std")} AS observation_id, person_id, m.std AS observation_concept_id,
       day AS observation_date, CASE WHEN part = 1 THEN value END AS value_as_number,
       CASE WHEN part = 2 AND event_id % 2 = 1 THEN 'part ' || user_id END AS value_as_string,
       b.std AS value_as_concept_id, CAST(900000000 + u.n_nationkey AS INT) AS unit_concept_id,
       'C' || pk AS observation_source_value, m.src AS observation_source_concept_id,
       CASE WHEN part = 1 THEN 'u' END AS unit_source_value,
       CASE WHEN part = 2 THEN CASE WHEN event_id % 2 = 1 THEN 'part ' || user_id ELSE 'C' || (user_id % 200) END END
         AS value_source_value
{_PART_FROM} 'Observation'""",
)
register(
    "view_observation_component",
    view(
        views.observation_component,
        "id status subject_id effective_dt effective_period_start component_code_system component_code "
        "component_value_num component_unit_code component_value_code component_value_string",
    ),
    with_(_EVENT, _PARTS)
    + f"""
SELECT oid AS id,
       CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'cancelled' WHEN event_id % 7 <> 0 THEN 'final' END AS status,
       'p' || user_id AS subject_id,
       CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-06:00' END AS effective_dt,
       CASE WHEN event_id % 2 = 1 THEN strftime(ts, '%Y-%m-%d') END AS effective_period_start,
       {M.system_of('pk')} AS component_code_system, 'C' || pk AS component_code,
       CASE WHEN part = 1 THEN value END AS component_value_num,
       CASE WHEN part = 1 THEN 'NATION_' || (user_id % 30) END AS component_unit_code,
       CASE WHEN part = 2 AND event_id % 2 = 0 THEN 'C' || (user_id % 200) END AS component_value_code,
       CASE WHEN part = 2 AND event_id % 2 = 1 THEN 'part ' || user_id END AS component_value_string
FROM parts""",
)

# --- events with prioritised codes ----------------------------------------------------------------


def _priority(codes: list[tuple[str, str, str]], domain: str | None, outer: bool = False) -> tuple[str, str, str]:
    """Joins, source code and standard concept for codes given as (vocabulary, key expression, condition)."""
    joins, hit, src, std = [], [], [], []
    for i, (vocab, key, when) in enumerate(codes):
        joins.append(f"LEFT JOIN b b{i} ON b{i}.vocab = '{vocab}' AND b{i}.code = 'C' || ({key}) AND {when}")
        hit.append(f"WHEN b{i}.src IS NOT NULL THEN 'C' || ({key})")
        src.append(f"WHEN b{i}.src IS NOT NULL THEN b{i}.src")
        std.append(f"WHEN b{i}.src IS NOT NULL THEN " + (f"coalesce(b{i}.std, 0)" if outer else f"b{i}.std"))
    case = "CASE {} END"
    body = (
        f"SELECT line.*, {case.format(' '.join(hit))} AS code, {case.format(' '.join(src))} AS src, "
        f"{case.format(' '.join(std))} AS std FROM line {' '.join(joins)}"
    )
    return f"coded AS (SELECT * FROM ({body}) WHERE code IS NOT NULL)"


def _best_outer() -> str:
    return (
        "b AS (SELECT c.vocabulary_id AS vocab, c.concept_code AS code, min(c.concept_id) AS src, min(m.std) AS std "
        "FROM concept c LEFT JOIN maps m ON m.src = c.concept_id AND m.dom = 'Drug' GROUP BY 1, 2)"
    )


def coded_line(codes, domain, outer=False) -> str:
    return with_(WITH_MAPS, LINE, _best_outer() if outer else best("b", domain), _priority(codes, domain, outer))


ODD, EVEN = "l_linenumber % 2 = 1", "l_linenumber % 2 = 0"
register(
    "edge_procedure_occurrence",
    edge(
        E.procedure_occurrence,
        "procedure_occurrence_id person_id procedure_concept_id procedure_date procedure_datetime "
        "procedure_end_date procedure_end_datetime provider_id visit_occurrence_id procedure_source_value "
        "procedure_source_concept_id procedure_type_concept_id",
        "Procedure",
    ),
    coded_line([("SNOMED", "base", EVEN), ("CPT4", "base + 7", "true")], "Procedure")
    + f"""
SELECT {hk("'x-' || lid")} AS procedure_occurrence_id, person_id, std AS procedure_concept_id,
       CASE WHEN l_returnflag = 'R' THEN day ELSE day + 1 END AS procedure_date,
       CASE WHEN l_returnflag = 'R' THEN CAST(day AS TIMESTAMP) + INTERVAL 8 HOUR
            ELSE CAST(day AS TIMESTAMP) + INTERVAL 1710 MINUTE END AS procedure_datetime,
       CASE WHEN l_returnflag = 'R' THEN day + 1 END AS procedure_end_date,
       CASE WHEN l_returnflag = 'R' THEN CAST(day AS TIMESTAMP) + INTERVAL 25 HOUR END AS procedure_end_datetime,
       supplier_key AS provider_id, visit_occurrence_id, code AS procedure_source_value,
       src AS procedure_source_concept_id, 32827 AS procedure_type_concept_id
FROM coded WHERE l_linenumber <> 1""",
)
_DRUG_COLS = (
    "drug_exposure_id person_id drug_concept_id drug_exposure_start_date drug_exposure_start_datetime "
    "drug_exposure_end_date drug_exposure_end_datetime drug_type_concept_id visit_occurrence_id drug_source_value "
    "drug_source_concept_id"
)
_TWO = [("RxNorm", "base + 2", ODD), ("NDC", "base + 4", "true")]


def _drug_sql(prefix: str, codes, type_concept: int, where: str, shift: str = "", extra: str = "", outer=False, end: str = "day", end_at: str | None = None) -> str:
    at = f"CAST(day AS TIMESTAMP){shift}"
    return coded_line(codes, "Drug", outer) + f"""
SELECT {hk(f"'{prefix}-' || lid")} AS drug_exposure_id, person_id, std AS drug_concept_id,
       day AS drug_exposure_start_date, {at} AS drug_exposure_start_datetime, {end} AS drug_exposure_end_date,
       {end_at or at} AS drug_exposure_end_datetime, {type_concept} AS drug_type_concept_id, visit_occurrence_id,
       code AS drug_source_value, src AS drug_source_concept_id{extra}
FROM coded WHERE {where}"""


register(
    "edge_medication_request",
    edge(E.medication_request, _DRUG_COLS + " provider_id", "MedicationRequest"),
    _drug_sql("mr", _TWO, 38000177, "l_linenumber <> 1", " + INTERVAL 12 HOUR", ", supplier_key AS provider_id"),
)
register(
    "edge_medication_administration",
    edge(E.medication_administration, _DRUG_COLS, "MedicationAdministration"),
    _drug_sql(
        "ma",
        [("RxNorm", "base + 2", ODD), ("NDC", "base + 4", "l_linenumber % 3 = 0"), ("SNOMED", "base + 6", "true")],
        38000179,
        "l_linenumber <> 1",
        " + INTERVAL 12 HOUR",
    ),
)
register(
    "edge_medication_dispense",
    edge(E.medication_dispense, _DRUG_COLS + " quantity days_supply", "MedicationDispense"),
    _drug_sql("md", _TWO, 38000176, "true", "", ", l_quantity AS quantity, l_linenumber * 10 AS days_supply"),
)
_STATEMENT_END = "CASE WHEN l_returnflag = 'A' THEN day + 9 ELSE day END"
register(
    "edge_medication_statement",
    edge(E.medication_statement, _DRUG_COLS, "MedicationStatement"),
    _drug_sql(
        "ms", _TWO, 38000178, "l_linenumber <> 1", "", end=_STATEMENT_END, end_at=f"CAST({_STATEMENT_END} AS TIMESTAMP)"
    ),
)
register(
    "edge_immunization",
    edge(E.immunization, _DRUG_COLS, "Immunization"),
    _drug_sql(
        "im", [("CVX", "base + 5", EVEN), ("RxNorm", "base + 2", "true")], 32827, "l_linenumber <> 1", outer=True
    ),
)
register(
    "edge_allergy_observation",
    edge(
        E.allergy_observation,
        "observation_id person_id observation_concept_id observation_date observation_datetime value_as_concept_id "
        "visit_occurrence_id observation_source_value observation_source_concept_id qualifier_source_value "
        "value_source_value",
        "AllergyIntolerance",
    ),
    coded_line([("SNOMED", "base + 9", ODD), ("RxNorm", "base + 2", "true")], None)
    + f"""
SELECT {hk("'al-' || lid")} AS observation_id, person_id, std AS observation_concept_id,
       CASE WHEN l_returnflag = 'A' THEN day ELSE DATE '2001-02-03' END AS observation_date,
       CASE WHEN l_returnflag = 'A' THEN CAST(day AS TIMESTAMP) ELSE TIMESTAMP '2001-02-03 04:05:06' END
         AS observation_datetime,
       std AS value_as_concept_id, visit_occurrence_id, code AS observation_source_value,
       src AS observation_source_concept_id,
       CASE l_linestatus WHEN 'O' THEN 'active' ELSE 'resolved' END AS qualifier_source_value,
       'free text' AS value_source_value
FROM coded WHERE l_linenumber <> 1""",
)
register(
    "edge_device_exposure",
    edge(
        E.device_exposure,
        "device_exposure_id person_id device_concept_id device_exposure_start_date device_exposure_start_datetime "
        "device_exposure_end_date unique_device_id production_id device_source_value device_source_concept_id",
        "Device",
    ),
    with_(WITH_MAPS, LINE)
    + f"""
SELECT {hk("'dv-' || lid")} AS device_exposure_id, person_id, std AS device_concept_id,
       day AS device_exposure_start_date, CAST(day AS TIMESTAMP) AS device_exposure_start_datetime,
       CASE WHEN l_linestatus = 'F' THEN DATE '2030-01-01' END AS device_exposure_end_date,
       'udi' || l_suppkey AS unique_device_id, 'lot' || l_linenumber AS production_id,
       code AS device_source_value, src AS device_source_concept_id
FROM line JOIN maps ON vocab = 'SNOMED' AND code = 'C' || (base + 6) AND dom = 'Device'
WHERE l_linenumber <> 1""",
)
register(
    "edge_specimen",
    edge(
        E.specimen,
        "specimen_id person_id specimen_concept_id specimen_date specimen_datetime quantity "
        "anatomic_site_concept_id specimen_source_value anatomic_site_source_value",
        "Specimen",
    ),
    with_(WITH_MAPS, LINE, best("k", "Specimen"), best("b", None))
    + f"""
SELECT {hk("'sp-' || lid")} AS specimen_id, person_id, coalesce(k.std, 0) AS specimen_concept_id,
       day AS specimen_date, CAST(day AS TIMESTAMP) + INTERVAL 7 HOUR AS specimen_datetime, l_quantity AS quantity,
       coalesce(b.std, 0) AS anatomic_site_concept_id, 'C' || base AS specimen_source_value,
       'C' || (base + 9) AS anatomic_site_source_value
FROM line LEFT JOIN k ON k.vocab = 'SNOMED' AND k.code = 'C' || base
          LEFT JOIN b ON b.vocab = 'SNOMED' AND b.code = 'C' || (base + 9)
WHERE l_linenumber <> 1""",
)

# --- people and places ----------------------------------------------------------------------------

_NO_ADDRESS = "c_custkey % 10 = 7"
_CITY = "CASE WHEN c_custkey % 2 = 0 THEN 'O' ELSE 'H' END || c_nationkey"
_LINE_TEXT = "'L' || c_nationkey || ' floor 1'"
_STATE = "'S' || (c_nationkey % 5)"
_ZIP = "CASE WHEN c_nationkey % 4 <> 0 THEN 'Z' || c_nationkey END"
_ADDRESS_KEY = hk(f"concat_ws('|', {_LINE_TEXT}, {_CITY}, {_STATE}, {_ZIP})")
_BORN = "(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT))"
_OMB = M.RACE_CODE
register(
    "edge_person",
    edge(
        E.person,
        "person_id gender_concept_id year_of_birth month_of_birth day_of_birth birth_datetime race_concept_id "
        "ethnicity_concept_id location_id provider_id care_site_id person_source_value gender_source_value "
        "gender_source_concept_id race_source_value race_source_concept_id ethnicity_source_value "
        "ethnicity_source_concept_id",
        "Patient",
    ),
    f"""
SELECT {hk("'p' || c_custkey")} AS person_id,
       CASE WHEN c_custkey % 3 = 0 THEN 8507 WHEN c_custkey % 3 = 1 THEN 8532
            ELSE CASE c_custkey % 5 WHEN 0 THEN 8507 WHEN 1 THEN 8532 WHEN 2 THEN 8521 ELSE 0 END END AS gender_concept_id,
       CAST(year({_BORN}) AS INT) AS year_of_birth, CAST(month({_BORN}) AS INT) AS month_of_birth,
       CAST(day({_BORN}) AS INT) AS day_of_birth,
       CAST({_BORN} AS TIMESTAMP) + CASE WHEN c_custkey % 4 = 0 THEN INTERVAL 1335 MINUTE ELSE INTERVAL 0 MINUTE END
         AS birth_datetime,
       CASE WHEN c_custkey % 9 = 0 THEN 8557 ELSE
         CASE c_custkey % 8 WHEN 0 THEN 8527 WHEN 1 THEN 8516 WHEN 2 THEN 8515 WHEN 3 THEN 8522 WHEN 4 THEN 8552 ELSE 0 END
       END AS race_concept_id,
       CASE c_custkey % 3 WHEN 0 THEN 38003563 WHEN 1 THEN 38003564 ELSE 0 END AS ethnicity_concept_id,
       CASE WHEN NOT ({_NO_ADDRESS}) THEN {_ADDRESS_KEY} END AS location_id,
       {hk("'s' || c_nationkey")} AS provider_id, {hk("'g' || c_nationkey")} AS care_site_id,
       'p' || c_custkey AS person_source_value,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE
         CASE c_custkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' WHEN 3 THEN 'odd' END END
         AS gender_source_value,
       CASE c_custkey % 3 WHEN 0 THEN 910000000 WHEN 1 THEN 910000001 ELSE 0 END AS gender_source_concept_id,
       CASE WHEN c_custkey % 9 = 0 THEN 'native' ELSE {M.RACE_TEXT} END AS race_source_value,
       0 AS race_source_concept_id, 'Some ethnicity' AS ethnicity_source_value, 0 AS ethnicity_source_concept_id
FROM customer""",
)
register(
    "edge_patient_location",
    edge(
        E.patient_location,
        "location_id address_1 city state zip county location_source_value country_concept_id country_source_value "
        "latitude longitude",
        "Patient",
    ),
    f"""
SELECT DISTINCT {_ADDRESS_KEY} AS location_id, {_LINE_TEXT} AS address_1, {_CITY} AS city, {_STATE} AS state,
       {_ZIP} AS zip, 'district' AS county, left(concat_ws(', ', {_LINE_TEXT}, {_CITY}, {_STATE}, {_ZIP}), 50)
         AS location_source_value,
       CASE c_nationkey % 3 WHEN 0 THEN 4330442 WHEN 1 THEN 4330427 ELSE 0 END AS country_concept_id,
       CASE c_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' ELSE 'FR' END AS country_source_value,
       c_nationkey + 0.25::DOUBLE AS latitude, c_nationkey - 0.5::DOUBLE AS longitude
FROM customer WHERE NOT ({_NO_ADDRESS})""",
)
register(
    "edge_death",
    edge(E.death, "person_id death_date death_datetime death_type_concept_id", "Patient"),
    f"SELECT {hk("'p' || c_custkey")} AS person_id, DATE '2020-05-06' AS death_date, "
    "TIMESTAMP '2020-05-06 23:59:00' AS death_datetime, 32817 AS death_type_concept_id "
    "FROM customer WHERE c_custkey % 6 = 0",
)
_SUPPLIER_GENDER = "CASE s_suppkey % 5 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} ELSE {} END"
_PROVIDER_SELECT = f"""
       {hk("'s' || s_suppkey")} AS provider_id,
       s_name || ', ' || CASE WHEN s_suppkey % 2 = 0 THEN 'Ann' ELSE 'B' END AS provider_name,
       '99' || s_suppkey AS npi, {_SUPPLIER_GENDER.format(8507, 8532, 8521, 8551, 0)} AS gender_concept_id,
       {_SUPPLIER_GENDER.format("'Male'", "'female'", "'other'", "'unknown'", "NULL")} AS gender_source_value,
       {_SUPPLIER_GENDER.format(8507, 8532, 0, 0, 0)} AS gender_source_concept_id,
       's' || s_suppkey AS provider_source_value"""
register(
    "edge_provider",
    edge(
        E.provider,
        "provider_id provider_name npi gender_concept_id gender_source_value gender_source_concept_id "
        "provider_source_value specialty_concept_id",
        "Practitioner",
    ),
    f"SELECT {_PROVIDER_SELECT}, 38004446 AS specialty_concept_id FROM supplier",
)
register(
    "edge_provider_roles",
    edge(
        E.provider_with_roles,
        "provider_id provider_name npi gender_concept_id gender_source_value gender_source_concept_id "
        "provider_source_value specialty_concept_id care_site_id",
        "Practitioner",
        "PractitionerRole",
    ),
    with_(
        WITH_MAPS,
        best("b", None),
        """roles AS (
  SELECT * FROM (
    SELECT s_suppkey - s_suppkey % 2 AS sk, b.std AS specialty, CASE WHEN s_suppkey % 3 = 0 THEN """
        + hk("'g' || s_nationkey")
        + """ END AS site,
           row_number() OVER (PARTITION BY s_suppkey - s_suppkey % 2
             ORDER BY b.std NULLS LAST, CASE WHEN s_suppkey % 3 = 0 THEN """
        + hk("'g' || s_nationkey")
        + """ END NULLS FIRST) AS rn
    FROM supplier LEFT JOIN b ON b.vocab = 'SNOMED' AND b.code = 'C' || ((s_suppkey % 20) * 10))
  WHERE rn = 1)""",
    )
    + f"SELECT {_PROVIDER_SELECT}, coalesce(specialty, 38004446) AS specialty_concept_id, site AS care_site_id "
    "FROM supplier LEFT JOIN roles ON sk = s_suppkey",
)
register(
    "edge_organization_care_site",
    edge(
        E.organization_care_site,
        "care_site_id care_site_name place_of_service_concept_id care_site_source_value place_of_service_source_value",
        "Organization",
    ),
    f"""
SELECT {hk("'g' || s_suppkey")} AS care_site_id, s_name AS care_site_name,
       CASE s_nationkey % 6 WHEN 0 THEN 8940 WHEN 1 THEN 4318944 WHEN 2 THEN 4030303 WHEN 3 THEN 4195901
         WHEN 4 THEN 4217012 ELSE 0 END AS place_of_service_concept_id,
       'g' || s_suppkey AS care_site_source_value,
       CASE s_nationkey % 6 WHEN 0 THEN 'prov' WHEN 1 THEN 'dept' WHEN 2 THEN 'edu' WHEN 3 THEN 'govt'
         WHEN 4 THEN 'team' ELSE 'other' END AS place_of_service_source_value
FROM supplier""",
)
register(
    "edge_location_care_site",
    edge(
        E.location_care_site,
        "care_site_id care_site_name place_of_service_concept_id location_id care_site_source_value "
        "place_of_service_source_value",
        "Location",
    ),
    f"""
SELECT {hk("'loc' || s_suppkey")} AS care_site_id, s_name AS care_site_name, 0 AS place_of_service_concept_id,
       {hk("'loc' || s_suppkey")} AS location_id, 'loc' || s_suppkey AS care_site_source_value,
       'C' || s_nationkey AS place_of_service_source_value
FROM supplier""",
)
register(
    "edge_location",
    edge(
        E.location_location,
        "location_id address_1 city zip location_source_value country_concept_id country_source_value latitude longitude",
        "Location",
    ),
    f"""
SELECT {hk("'loc' || s_suppkey")} AS location_id, '1 Road Box ' || s_suppkey AS address_1,
       'City' || s_nationkey AS city, left('12345-67890' || s_nationkey, 9) AS zip,
       'State ' || s_nationkey AS location_source_value,
       CASE WHEN s_nationkey % 2 = 0 THEN 4330439 ELSE 0 END AS country_concept_id,
       CASE WHEN s_nationkey % 2 = 0 THEN 'DE' ELSE 'XX' END AS country_source_value,
       s_acctbal AS latitude, -s_acctbal AS longitude
FROM supplier""",
)
_VISIT = f"""
visit AS (
  SELECT *, CAST(o_orderdate AS DATE) + 1 AS start_day,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1590 MINUTE AS start_at,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INT) AS TIMESTAMP)
                + INTERVAL 23 HOUR
              ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 1590 MINUTE END AS end_at,
         {hk("'p' || o_custkey")} AS person_id
  FROM orders WHERE o_orderstatus <> 'P'
)"""
register(
    "edge_visit_occurrence",
    edge(
        E.visit_occurrence,
        "visit_occurrence_id person_id visit_concept_id visit_start_date visit_start_datetime visit_end_date "
        "visit_end_datetime provider_id care_site_id visit_source_value admitted_from_source_value "
        "discharged_to_source_value preceding_visit_occurrence_id",
        "Encounter",
    ),
    with_(_VISIT)
    + f"""
SELECT {hk("'e' || o_orderkey")} AS visit_occurrence_id, person_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 9203 WHEN '2-HIGH' THEN 9201 WHEN '3-MEDIUM' THEN 9202
         WHEN '5-LOW' THEN 722455 ELSE 0 END AS visit_concept_id,
       start_day AS visit_start_date, start_at AS visit_start_datetime, CAST(end_at AS DATE) AS visit_end_date,
       end_at AS visit_end_datetime, {hk("'s' || (o_custkey % 10)")} AS provider_id,
       {hk("'g' || (o_custkey % 7)")} AS care_site_id, 'e' || o_orderkey AS visit_source_value,
       'emd' AS admitted_from_source_value,
       CASE WHEN o_orderkey % 2 = 0 THEN 'home' END AS discharged_to_source_value,
       CASE WHEN o_orderkey % 5 = 0 THEN {hk("'e' || (o_orderkey - 1)")} END AS preceding_visit_occurrence_id
FROM visit""",
)
register(
    "edge_observation_period",
    edge(
        E.observation_period,
        "observation_period_id person_id observation_period_start_date observation_period_end_date "
        "period_type_concept_id",
        "Patient",
        "Encounter",
    ),
    with_(_VISIT)
    + """
SELECT person_id AS observation_period_id, person_id, min(start_day) AS observation_period_start_date,
       max(CAST(end_at AS DATE)) AS observation_period_end_date, 44814724 AS period_type_concept_id
FROM visit JOIN customer ON c_custkey = o_custkey GROUP BY person_id""",
)
register(
    "edge_payer_plan_period",
    edge(
        E.payer_plan_period,
        "payer_plan_period_id person_id payer_plan_period_start_date payer_plan_period_end_date payer_source_value "
        "plan_source_value payer_concept_id",
        "Coverage",
    ),
    f"""
WITH v AS (
  SELECT *, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS s,
         CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 365 END AS e FROM orders)
SELECT {hk("'v' || o_orderkey")} AS payer_plan_period_id, {hk("'p' || o_custkey")} AS person_id,
       coalesce(s, e) AS payer_plan_period_start_date, coalesce(e, s) AS payer_plan_period_end_date,
       'Payer ' || (o_custkey % 6) AS payer_source_value, o_orderpriority AS plan_source_value, 0 AS payer_concept_id
FROM v WHERE s IS NOT NULL OR e IS NOT NULL""",
)
