"""Clinical CSV-shaped sources derived from the given tables. The same SELECT texts run in both engines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from checks import mirror as M
from medloom.plans.csv_cdm import Sources
from medloom.session import written

DAY0 = "DATE '2000-01-01'"
_START = f"({DAY0} + CAST((o_orderkey * 37 + o_custkey) % 120 AS INT))"
_LINE_DAY = f"({DAY0} + CAST((l_partkey * 11 + l_linenumber) % 150 AS INT))"
_BASE = "(l_partkey - l_partkey % 10)"
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, o_orderkey, o_custkey"
)
LID = M.LINE_ID

TEXTS: dict[str, str] = {
    "patients": """
SELECT 'p' || c_custkey AS id, DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) AS birthdate,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'F' END AS gender,
       CASE c_custkey % 4 WHEN 0 THEN 'white' WHEN 1 THEN 'black' WHEN 2 THEN 'asian' ELSE 'native' END AS race,
       CASE c_custkey % 3 WHEN 0 THEN 'hispanic' WHEN 1 THEN 'nonhispanic' ELSE 'x' END AS ethnicity,
       'City' || (c_nationkey % 5) AS city,
       CASE c_nationkey % 3 WHEN 0 THEN 'Texas' WHEN 1 THEN 'Ohio' ELSE 'Nowhere' END AS state,
       'Z' || (c_nationkey % 10) AS zip
FROM customer""",
    "organizations": "SELECT 'g' || s_suppkey AS id, s_name AS name FROM supplier",
    "providers": """
SELECT 's' || s_suppkey AS id, s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
       'GENERAL' AS speciality FROM supplier""",
    "payers": "SELECT 'y' || n_nationkey AS id, n_name AS name FROM nation",
    "encounters": f"""
SELECT 'e' || o_orderkey AS id, {_START} AS start,
       CASE WHEN o_orderkey % 101 = 0 THEN {_START} - 2 ELSE {_START} + CAST(o_orderkey % 13 AS INT) END AS stop,
       'p' || o_custkey AS patient, 'g' || (o_custkey % 7) AS organization, 's' || (o_orderkey % 12) AS provider,
       'y' || (o_orderkey % 6) AS payer,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN 'inpatient'
            WHEN '3-MEDIUM' THEN 'ambulatory'
            WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'wellness' ELSE 'outpatient' END
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'urgentcare' ELSE 'urgent' END END AS encounterclass,
       CASE WHEN o_orderkey % 50 = 0 THEN '308646001' ELSE 'x' END AS code,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_claim_cost,
       CAST(o_orderkey % 1000 AS DECIMAL(18,2)) AS payer_coverage, 'C' || ((o_orderkey * 7 + o_custkey) % 200) AS reasoncode
FROM orders""",
    "payer_transitions": f"""
SELECT 'p' || o_custkey AS patient, 'y' || (o_orderkey % 30) AS payer, {_START} - 20 AS start_date,
       {_START} + CAST(o_orderkey % 200 AS INT) AS end_date
FROM orders""",
    "conditions": f"""
SELECT {_LINE_DAY} AS start, CASE WHEN l_returnflag <> 'R' THEN {_LINE_DAY} + CAST(l_quantity AS INT) END AS stop,
       'p' || o_custkey AS patient, 'e' || l_orderkey AS encounter, 'C' || l_partkey AS code
FROM {_LINES}""",
    "medications": f"""
SELECT {_LINE_DAY} AS start, CASE WHEN l_returnflag <> 'R' THEN {_LINE_DAY} + CAST(l_quantity AS INT) END AS stop,
       'p' || o_custkey AS patient, 'e' || l_orderkey AS encounter, 'C' || ({_BASE} + 2) AS code,
       CAST(l_quantity AS DECIMAL(18,2)) AS base_cost
FROM {_LINES}""",
    "immunizations": f"""
SELECT {_LINE_DAY} AS date, 'p' || o_custkey AS patient, 'e' || l_orderkey AS encounter,
       'C' || ({_BASE} + 5) AS code, CAST(l_linenumber AS DECIMAL(18,2)) AS base_cost
FROM {_LINES}""",
    "procedures": f"""
SELECT {_LINE_DAY} AS start, {_LINE_DAY} + l_linenumber AS stop, 'p' || o_custkey AS patient,
       'e' || l_orderkey AS encounter, 'C' || l_partkey AS code, CAST(l_quantity AS DECIMAL(18,2)) AS base_cost
FROM {_LINES}""",
    "devices": f"""
SELECT {_LINE_DAY} AS start, CAST(NULL AS DATE) AS stop, 'p' || o_custkey AS patient, 'e' || l_orderkey AS encounter,
       'C' || ({_BASE} + 6) AS code, 'udi' || l_suppkey AS udi
FROM {_LINES}""",
    "allergies": f"""
SELECT {_LINE_DAY} AS start, 'p' || o_custkey AS patient, 'e' || l_orderkey AS encounter,
       'C' || ({_BASE} + 9) AS code
FROM {_LINES}""",
    "observations": """
SELECT CAST(ts AS DATE) AS date, 'p' || user_id AS patient, 'e' || (event_id % 1500) AS encounter,
       'C' || (event_id % 200) AS code,
       CASE event_type WHEN 'click' THEN '1' || (event_id % 90) || '.5' WHEN 'view' THEN 'n/a'
            WHEN 'error' THEN 'C' || (event_id % 200) WHEN 'signup' THEN NULL ELSE '-3' END AS value,
       'NATION_' || (user_id % 30) AS units
FROM events""",
    "claims": f"""
SELECT 'k' || {LID} AS id, 'p' || o_custkey AS patientid, 's' || (o_orderkey % 12) AS providerid,
       'y' || (o_orderkey % 6) AS primarypatientinsuranceid, 'C' || l_partkey AS diagnosis1,
       {_LINE_DAY} AS currentillnessdate, {_START} AS servicedate, 'e' || o_orderkey AS appointmentid
FROM {_LINES}""",
    "claims_transactions": f"""
SELECT 'k' || {LID} AS claimid, 'p' || o_custkey AS patientid, 'e' || o_orderkey AS appointmentid,
       's' || (o_orderkey % 12) AS providerid, CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN 'p' ELSE 'x' END
       AS transfertype, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
FROM {_LINES}
UNION ALL
SELECT 'k' || {LID}, 'p' || o_custkey, 'e' || o_orderkey, 's' || (o_orderkey % 12), '1',
       CAST(l_linenumber AS DECIMAL(18,2))
FROM {_LINES}""",
}


def sources(spark: SparkSession, sf_dir: str, materialize: bool = False, stored: bool = False) -> Sources:
    """The source tables. With ``stored`` the lines with their orders, of which most sources are made, are joined and written once."""
    M.views(spark, sf_dir, "customer", "supplier", "nation", "orders", "lineitem", "events")
    texts = TEXTS
    if stored:
        written(spark.sql(f"SELECT {_LINE_COLUMNS} FROM {_LINES}")).createOrReplaceTempView("order_lines")
        texts = {name: text.replace(_LINES, "order_lines") for name, text in TEXTS.items()}
    return Sources({name: spark.sql(text) for name, text in texts.items()}, M.vocabulary(spark, sf_dir), materialize=materialize)


def ctes(*names: str) -> str:
    return ",\n".join(f"{name} AS ({TEXTS[name]})" for name in names)
