"""Registered queries of sources, keys, terminology, references and quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import mirror as M
from checks.fhir_queries import LINE, WITH_MAPS, Build, context, hk, with_
from medloom.functions import keys as K
from medloom.operators import quality as QL
from medloom.operators import references as R
from medloom.operators import terminology as V
from medloom.operators.flatten import Col, Columns, ForEach, UnionAll, View, descend, flatten, flatten_parsed
from medloom.plans import edges as E
from medloom.plans import views
from medloom.session import scratch_path
from medloom.sources import conceptmaps, fhir

Q: dict[str, Build] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(build: Build) -> Build:
        Q[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


# --- sources --------------------------------------------------------------------------------------


@register(
    "latest_wins",
    """
SELECT event_type AS resource_type, CAST(user_id AS VARCHAR) AS id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("resource_type"), F.col("user_id").cast("string").alias("id"), "event_id", "ts"
    )
    return fhir.latest(rows, F.desc("ts"), F.desc("event_id")).drop("ts")


@register(
    "upsert_resources",
    """
SELECT 'Order' AS resource_type, CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'old' END AS resource FROM orders""",
)
def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = M.table(spark, sf_dir, "orders")
    head = [F.lit("Order").alias("resource_type"), F.col("o_orderkey").cast("string").alias("id")]
    current = orders.select(*head, F.lit("old").alias("resource"))
    incoming = orders.where("o_orderstatus = 'P'").select(*head, F.lit("new").alias("resource"))
    return fhir.upsert(current, incoming)


def _bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bundle text per order: an encounter and an entry without id; some texts are broken or bare."""
    encounters = M.resources(spark, sf_dir, "Encounter")
    bundle = F.concat(
        F.lit('{"resourceType":"Bundle","entry":[{"resource":'),
        "resource",
        F.lit('},{"resource":{"resourceType":"Basic"}}]}'),
    )
    number = F.regexp_extract("id", "[0-9]+", 0).cast("long")
    text = F.when(number % 100 == 3, F.lit('{"resourceType":"Bundle", broken')).when(number % 100 == 4, F.col("resource"))
    return encounters.select(text.otherwise(bundle).alias("value"), F.col("id").alias("file"))


@register(
    "bundle_entries",
    "SELECT 'Encounter' AS resource_type, 'e' || o_orderkey AS id FROM orders WHERE o_orderkey % 100 <> 3",
)
def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fhir.loadable(fhir.entries(_bundles(spark, sf_dir))).select("resource_type", "id")


@register(
    "bundle_load_counts",
    """
SELECT 'Encounter' AS resource_type, count(*) FILTER (o_orderkey % 100 <> 3) AS inserted, 0 AS skipped,
       0 AS broken_files FROM orders
UNION ALL SELECT 'Basic', 0, count(*) FILTER (o_orderkey % 100 NOT IN (3, 4)), 0 FROM orders
UNION ALL SELECT NULL, 0, 0, count(*) FILTER (o_orderkey % 100 = 3) FROM orders""",
)
def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fhir.load_counts(fhir.entries(_bundles(spark, sf_dir)))


@register(
    "line_export_load",
    """
SELECT 'Order' AS resource_type, CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderkey % 100 = 5 THEN 'old' ELSE o_orderstatus END AS status,
       o_orderkey % 100 <> 5 AND o_orderkey % 2 = 0 AS has_note
FROM orders WHERE o_orderkey % 100 <> 3""",
)
def _line_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as an export of one bundle a line, with an older version before the newer; some lines are broken, some second
    versions have an empty id, every other newer version has an element without a value in the resource schema."""
    orders = M.table(spark, sf_dir, "orders")
    key, number = F.col("o_orderkey").cast("string"), F.col("o_orderkey")
    note = F.when(number % 2 == 0, F.lit(',"note":{"text":"a \\"quoted\\" note"}')).otherwise("")
    line = F.concat(
        F.lit('{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Order","id":"'),
        key,
        F.lit('","status":"old"}},{"resource":{"resourceType":"Order","id":"'),
        F.when(number % 100 == 5, "").otherwise(key),
        F.lit('","status":"'),
        "o_orderstatus",
        F.lit('"'),
        note,
        F.lit("}}]}"),
    )
    folder = f"{scratch_path(spark, 'lines')}/data"
    orders.select(F.when(number % 100 == 3, F.concat(line, F.lit("]"))).otherwise(line).alias("value")).write.text(folder)
    resources = fhir.load(spark, folder, lines=True)
    return resources.select(
        "resource_type",
        "id",
        F.get_json_object("resource", "$.status").alias("status"),
        F.get_json_object("resource", "$.note.text").isNotNull().alias("has_note"),
    )


@register(
    "resource_table_names",
    "SELECT lower(event_type) || '_report' AS table_name, count(*) AS n FROM events GROUP BY 1",
)
def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.concat(F.initcap("event_type"), F.lit("Report"))
    return (
        M.table(spark, sf_dir, "events")
        .groupBy(fhir.table_name(kind).alias("table_name"))
        .agg(F.count("*").alias("n"))
    )


@register(
    "concept_map_rows",
    """
SELECT 'region_' || n_regionkey AS map_id, n_name AS source_code, CAST(100 + n_nationkey AS INT) AS concept_id,
       CASE WHEN n_regionkey % 2 = 0 THEN CAST(900000000 + n_nationkey AS INT) ELSE 0 END AS source_concept_id,
       CAST(100 + n_nationkey AS VARCHAR) AS target_code
FROM nation""",
)
def _map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = M.table(spark, sf_dir, "nation")
    target = F.array(F.struct((F.col("n_nationkey") + 100).cast("string").alias("code")))
    element = F.struct(F.col("n_name").alias("code"), F.col("n_name").alias("display"), target.alias("target"))
    by_region = nation.groupBy("n_regionkey").agg(F.collect_list(element).alias("element"))
    declared = F.array(
        F.struct(F.lit("https://host.example/source-vocabulary").alias("url"), F.lit("UCUM").alias("valueString"))
    )
    extension = F.when(F.col("n_regionkey") % 2 == 0, declared)
    group = F.array(F.struct(extension.alias("extension"), F.col("element")))
    texts = by_region.select(
        F.to_json(
            F.struct(
                F.lit("ConceptMap").alias("resourceType"),
                F.concat(F.lit("region-"), "n_regionkey").alias("id"),
                group.alias("group"),
            )
        ).alias("value")
    )
    rows = conceptmaps.from_resources(texts, M.vocabulary(spark, sf_dir).concept)
    rows = conceptmaps.require_unique(rows, "map_id", "source_code")
    return rows.select("map_id", "source_code", "concept_id", "source_concept_id", "target_code")


@register(
    "concept_map_lookup",
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 9202 WHEN 'O' THEN 581476 ELSE 0 END AS visit_concept_id FROM orders""",
)
def _map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "F", "AMB").when(F.col("o_orderstatus") == "O", "HH").otherwise("none")
    orders = M.table(spark, sf_dir, "orders").withColumn("code", code)
    found = conceptmaps.attach(
        orders, conceptmaps.built_in(spark, "encounter_class"), F.col("code"), found="concept_id"
    )
    return found.select("o_orderkey", F.coalesce("found", F.lit(0)).alias("visit_concept_id"))


# --- keys and references --------------------------------------------------------------------------


@register(
    "hash_keys",
    f"""
SELECT c_custkey, {hk('c_name')} AS name_id, {hk("CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END")} AS some_id,
       {hk("c_name || '|' || c_nationkey")} AS coded_id, {hk("c_name || '/' || c_mktsegment || '|' || c_nationkey")} AS part_id,
       {hk("concat_ws('|', CASE WHEN c_custkey % 3 = 0 THEN c_name END, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END)")}
         AS address_id
FROM customer""",
)
def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = M.table(spark, sf_dir, "customer")
    df = df.withColumn("line", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))).withColumn(
        "town", F.when(F.col("c_custkey") % 5 == 0, F.col("c_mktsegment"))
    )
    return df.select(
        "c_custkey",
        K.string_id("c_name").alias("name_id"),
        K.reference_id(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("")).alias("some_id"),
        K.coded_id("c_name", "c_nationkey").alias("coded_id"),
        K.component_id("c_name", "c_mktsegment", "c_nationkey").alias("part_id"),
        K.address_id("line", "town").alias("address_id"),
    )


def _searching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters that search their practitioner by number, next to the practitioners."""
    encounters = M.resources(spark, sf_dir, "Encounter")
    search = "Practitioner?identifier=http://hl7.org/fhir/sid/us-npi|99"
    text = F.regexp_replace("resource", "Practitioner/s", search)
    return encounters.withColumn("resource", text).unionByName(M.resources(spark, sf_dir, "Practitioner"))


@register(
    "search_references",
    """
SELECT 'e' || o_orderkey AS id,
       CASE WHEN s_suppkey IS NOT NULL THEN 's' || (o_custkey % 10)
            ELSE 'Practitioner?identifier=http:/hl7.org/fhir/sid/us-npi|99' || (o_custkey % 10) END AS performer_ref
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey % 10""",
)
def _resolved_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _searching(spark, sf_dir)
    direct = R.resolve_references(raw, R.identifier_index(raw))
    return flatten(direct, views.encounter).select("id", "performer_ref")


@register(
    "search_reference_counts",
    """
SELECT 'Encounter' AS resource_type, count(*) AS rows, count(*) AS references
FROM orders JOIN supplier ON s_suppkey = o_custkey % 10""".replace("AS references", 'AS "references"').replace(
        "AS rows", 'AS "rows"'
    ),
)
def _reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _searching(spark, sf_dir)
    return R.count_resolvable(raw, R.identifier_index(raw))


@register(
    "rekey_tables",
    f"""
SELECT 'person' AS source, {hk("'p' || c_custkey")} AS person_id, CAST(NULL AS BIGINT) AS visit_occurrence_id FROM customer
UNION ALL SELECT 'visit_occurrence', {hk("'p' || o_custkey")}, {hk("'e' || o_orderkey")} FROM orders
UNION ALL SELECT 'condition_occurrence', {hk("'p' || o_custkey")}, {hk("'e' || l_orderkey")}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _rekeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = M.table(spark, sf_dir, "orders")
    lines = M.table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    tables = {
        "person": M.table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("person_id"), F.concat(F.lit("p"), "c_custkey").alias("person_source_value")
        ),
        "visit_occurrence": orders.select(
            F.col("o_orderkey").alias("visit_occurrence_id"),
            F.col("o_custkey").alias("person_id"),
            F.concat(F.lit("e"), "o_orderkey").alias("visit_source_value"),
        ),
        "condition_occurrence": lines.select(
            F.col("o_custkey").alias("person_id"), F.col("l_orderkey").alias("visit_occurrence_id")
        ),
    }
    none = F.lit(None).cast("long")
    out = None
    for name, df in E.rekey_tables(tables).items():
        visit = F.col("visit_occurrence_id") if "visit_occurrence_id" in df.columns else none
        part = df.select(F.lit(name).alias("source"), "person_id", visit.alias("visit_occurrence_id"))
        out = part if out is None else out.unionByName(part)
    return out


# --- terminology ----------------------------------------------------------------------------------


@register(
    "maps_to",
    with_(WITH_MAPS, LINE)
    + f"SELECT lid AS id, src AS src_concept_id, std AS std_concept_id, dom AS std_domain "
    f"FROM line JOIN maps ON vocab = {M.vocabulary_of('l_partkey')} AND code = 'C' || l_partkey",
)
def _maps_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "lineitem").selectExpr(
        f"{M.LINE_ID} AS id", f"{M.system_of('l_partkey')} AS system", "concat('C', l_partkey) AS code"
    )
    systems = conceptmaps.built_in(spark, "system_vocabulary")
    walked = V.maps_to(rows, M.vocabulary(spark, sf_dir), "system", "code", systems)
    return walked.select("id", "src_concept_id", "std_concept_id", "std_domain")


_PAIRS = ", ".join(f"('{v}', '{d}')" for v, d in V.VOCABULARY_DOMAINS)


@register(
    "domain_maps",
    with_(WITH_MAPS)
    + f"""
SELECT vocab AS vocabulary_id, dom AS std_domain, code AS source_code, min(std) AS std_concept_id
FROM maps WHERE (vocab, dom) IN ({_PAIRS}) GROUP BY ALL""",
)
def _domain_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = M.vocabulary(spark, sf_dir).all_domain_maps()
    return maps.select("vocabulary_id", "std_domain", "source_code", "std_concept_id")


@register(
    "domain_map_snomed_procedure",
    with_(WITH_MAPS)
    + """
SELECT code AS source_code, min(src) AS source_concept_id, min(std) AS std_concept_id
FROM maps WHERE vocab = 'SNOMED' AND dom = 'Procedure' GROUP BY code""",
)
def _domain_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.vocabulary(spark, sf_dir).domain_map("SNOMED", "Procedure").drop("std_concept_name")


@register(
    "priority_coding",
    with_(WITH_MAPS, "b AS (SELECT vocab, code, min(std) AS std FROM maps WHERE dom = 'Drug' GROUP BY 1, 2)")
    + """
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice,
       CASE WHEN a.std IS NOT NULL THEN 'C' || (l_partkey - l_partkey % 10 + 2) ELSE 'C' || (l_partkey - l_partkey % 10 + 4) END AS src_code,
       coalesce(a.std, n.std) AS std_concept_id
FROM lineitem
LEFT JOIN b a ON a.vocab = 'RxNorm' AND a.code = 'C' || (l_partkey - l_partkey % 10 + 2) AND l_linenumber % 2 = 1
LEFT JOIN b n ON n.vocab = 'NDC' AND n.code = 'C' || (l_partkey - l_partkey % 10 + 4)
WHERE coalesce(a.std, n.std) IS NOT NULL""",
)
def _priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        f"CASE WHEN l_linenumber % 2 = 1 THEN concat('C', {M.BASE} + 2) END AS rx",
        f"concat('C', {M.BASE} + 4) AS ndc",
    )
    found = V.resolve_priority(rows, M.vocabulary(spark, sf_dir), [("RxNorm", "rx"), ("NDC", "ndc")], "Drug")
    return found.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "src_code", "std_concept_id")


@register(
    "value_sets",
    with_(WITH_MAPS)
    + " UNION ALL ".join(
        f"SELECT '{d}' AS domain, vocabulary_id, concept_code, concept_name FROM concept "
        f"WHERE domain_id = '{d}' AND standard_concept = 'S'"
        for d in ("Condition", "Device", "Drug", "Measurement", "Observation", "Procedure", "Specimen", "Visit")
    )
    + """ UNION ALL SELECT 'Condition', c.vocabulary_id, c.concept_code, c.concept_name
FROM maps m JOIN concept c ON c.concept_id = m.src WHERE m.dom = 'Condition' AND c.standard_concept IS DISTINCT FROM 'S'""",
)
def _value_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, out = M.vocabulary(spark, sf_dir), None
    for d in ("Condition", "Device", "Drug", "Measurement", "Observation", "Procedure", "Specimen", "Visit"):
        part = V.domain_value_set(vocabulary, d).select(F.lit(d).alias("domain"), "*")
        out = part if out is None else out.unionAll(part)
    return out


@register(
    "value_set_by_id",
    "SELECT CAST(900000000 + n_nationkey AS VARCHAR) AS code, n_name AS display FROM nation WHERE n_nationkey IN (1, 5, 7)",
)
def _id_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [900000001, 900000005, 900000007, 8527]
    return V.id_value_set(M.vocabulary(spark, sf_dir), "UCUM", ids, "Unit")


@register(
    "value_set_binding",
    with_(WITH_MAPS)
    + f"""
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
WHERE ({M.vocabulary_of('l_partkey')}, 'C' || l_partkey) IN (
  SELECT vocabulary_id, concept_code FROM concept WHERE domain_id = 'Measurement' AND standard_concept = 'S')""",
)
def _binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        f"{M.vocabulary_of('l_partkey')} AS vocabulary_id",
        "concat('C', l_partkey) AS code",
    )
    members = V.domain_value_set(M.vocabulary(spark, sf_dir), "Measurement")
    return V.bound_to(rows, members, "vocabulary_id", "code").drop("vocabulary_id", "code")


_CUSTOM = """
SELECT concat('X', p_partkey) AS source_code, CAST(0 AS INT) AS source_concept_id, p_name AS source_code_description,
       'LOCAL' AS source_vocabulary_id, CAST(p_partkey + 2 AS INT) AS target_concept_id,
       'SNOMED' AS target_vocabulary_id, DATE '2001-01-01' AS valid_start_date, DATE '2050-01-01' AS valid_end_date,
       CASE WHEN p_size % 20 = 0 THEN 'D' END AS invalid_reason
FROM part WHERE p_size % 10 = 0"""
_SOURCE_COLUMNS = (
    "source_code source_concept_id source_vocabulary_id source_domain_id target_concept_id target_vocabulary_id "
    "target_domain_id target_standard_concept target_invalid_reason"
)
_CUSTOM_ROWS = """
SELECT m.source_code, m.source_concept_id, m.source_vocabulary_id, NULL, m.target_concept_id, m.target_vocabulary_id,
       t.domain_id, t.standard_concept, t.invalid_reason
FROM custom m LEFT JOIN concept t ON t.concept_id = m.target_concept_id WHERE m.invalid_reason IS NULL"""


def _custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    M.views(spark, sf_dir, "part")
    return spark.sql(_CUSTOM)


@register(
    "source_to_source_map",
    with_(WITH_MAPS, f"custom AS ({_CUSTOM})")
    + f"""
SELECT concept_code AS source_code, concept_id AS source_concept_id, vocabulary_id AS source_vocabulary_id,
       domain_id AS source_domain_id, concept_id AS target_concept_id, vocabulary_id AS target_vocabulary_id,
       domain_id AS target_domain_id, standard_concept AS target_standard_concept,
       invalid_reason AS target_invalid_reason
FROM concept UNION {_CUSTOM_ROWS}""",
)
def _source_to_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.source_to_source(M.vocabulary(spark, sf_dir), _custom(spark, sf_dir))
    return rows.select(*_SOURCE_COLUMNS.split())


@register(
    "source_to_standard_map",
    with_(WITH_MAPS, f"custom AS ({_CUSTOM})")
    + f"""
SELECT s.concept_code AS source_code, s.concept_id AS source_concept_id, s.vocabulary_id AS source_vocabulary_id,
       s.domain_id AS source_domain_id, t.concept_id AS target_concept_id, t.vocabulary_id AS target_vocabulary_id,
       t.domain_id AS target_domain_id, t.standard_concept AS target_standard_concept,
       t.invalid_reason AS target_invalid_reason
FROM relationship r JOIN concept s ON s.concept_id = r.concept_id_1 JOIN concept t ON t.concept_id = r.concept_id_2
WHERE r.relationship_id = 'Maps to' AND r.invalid_reason IS NULL AND t.invalid_reason IS NULL UNION {_CUSTOM_ROWS}""",
)
def _source_to_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.source_to_standard(M.vocabulary(spark, sf_dir), _custom(spark, sf_dir))
    return rows.select(*_SOURCE_COLUMNS.split())


@register(
    "concept_by_id",
    with_(WITH_MAPS) + "SELECT concept_id, concept_name, domain_id, vocabulary_id, concept_code FROM concept WHERE concept_id = 42",
)
def _by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = V.concept_by_id(M.vocabulary(spark, sf_dir), 42)
    return found.select("concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_code")


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with two concept columns."""
    return M.table(spark, sf_dir, "events").select(
        "event_id",
        ((F.col("event_id") * 3) % 190 + 1).cast("int").alias("first_concept_id"),
        F.when(F.col("user_id") % 2 == 0, (F.col("user_id") % 150 + 1)).otherwise(0).cast("int").alias("second_concept_id"),
    )


_USED = """
used AS (
  SELECT DISTINCT CAST((event_id * 3) % 190 + 1 AS INT) AS concept_id FROM events
  UNION SELECT CAST(CASE WHEN user_id % 2 = 0 THEN user_id % 150 + 1 ELSE 0 END AS INT) FROM events
  UNION SELECT CAST(l_partkey - l_partkey % 3 + 1 AS INT) FROM lineitem)"""


def _used(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = M.table(spark, sf_dir, "lineitem").selectExpr("l_partkey - l_partkey % 3 + 1 AS line_concept_id")
    return V.used_concepts([_event_rows(spark, sf_dir), lines])


@register("used_concepts", with_(_USED) + "SELECT concept_id FROM used")
def _used_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _used(spark, sf_dir)


def _both_parts(vocabulary: V.Vocabulary) -> DataFrame:
    concept = vocabulary.concept.select(F.lit("concept").alias("part"), F.col("concept_id").alias("a"), F.lit(0).alias("b"))
    links = vocabulary.relationship.select(
        F.lit("link").alias("part"), F.col("concept_id_1").alias("a"), F.col("concept_id_2").alias("b")
    )
    return concept.unionByName(links)


_PARTS = """
SELECT 'concept' AS part, concept_id AS a, 0 AS b FROM concept WHERE concept_id IN (SELECT concept_id FROM {0})
UNION ALL SELECT 'link', concept_id_1, concept_id_2 FROM relationship
WHERE concept_id_1 IN (SELECT concept_id FROM {0}) AND concept_id_2 IN (SELECT concept_id FROM {0})"""


@register("prune_vocabulary", with_(WITH_MAPS, _USED) + _PARTS.format("used"))
def _pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_parts(V.prune_vocabulary(M.vocabulary(spark, sf_dir), _used(spark, sf_dir)))


@register(
    "vocabulary_slice",
    with_(
        WITH_MAPS,
        _USED,
        f"""
seeds AS (
  SELECT concept_id FROM used UNION SELECT c.concept_id FROM concept c JOIN (
    SELECT DISTINCT {M.vocabulary_of('l_partkey - l_partkey % 4')} AS v, 'C' || (l_partkey - l_partkey % 4) AS code
    FROM lineitem) x
  ON x.v = c.vocabulary_id AND x.code = c.concept_code),
closed AS (
  SELECT concept_id FROM seeds UNION SELECT concept_id_2 FROM relationship
  WHERE relationship_id = 'Maps to' AND invalid_reason IS NULL AND concept_id_1 IN (SELECT concept_id FROM seeds))""",
    )
    + _PARTS.format("closed"),
)
def _slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = "l_partkey - l_partkey % 4"
    codings = M.table(spark, sf_dir, "lineitem").selectExpr(
        f"{M.vocabulary_of(part)} AS vocabulary_id", f"concat('C', {part}) AS concept_code"
    )
    return _both_parts(V.vocabulary_slice(M.vocabulary(spark, sf_dir), _used(spark, sf_dir), codings))


@register(
    "decorated_sample",
    with_(
        WITH_MAPS,
        """
sample AS (SELECT event_id, CAST((event_id * 3) % 190 + 1 AS INT) AS a,
           CAST(CASE WHEN user_id % 2 = 0 THEN user_id % 150 + 1 ELSE 0 END AS INT) AS b
           FROM events ORDER BY event_id LIMIT 25),
ids AS (SELECT event_id, 'first_concept_id' AS "column", a AS concept_id FROM sample
        UNION ALL SELECT event_id, 'second_concept_id', b FROM sample)""",
    )
    + """
SELECT event_id, "column", concept_id, concept_name, vocabulary_id, domain_id, coalesce(standard_concept = 'S', false) AS standard,
       (SELECT count(*) FROM events) AS total
FROM ids JOIN concept USING (concept_id) WHERE concept_id > 0""",
)
def _decorated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.decorate(_event_rows(spark, sf_dir), M.vocabulary(spark, sf_dir), 25, "event_id")


# --- flattening forms the shipped views do not use ------------------------------------------------

_NESTED = "struct<id:bigint,k:int,kind:string,names:array<struct<use:string,parts:array<string>>>>"


@register(
    "view_nested_forms",
    """
WITH e AS (SELECT event_id, event_type, user_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
SELECT event_id AS id, k, 'b' AS use, CAST(user_id AS VARCHAR) AS part, event_type || '+' || user_id AS joined FROM e WHERE event_type = 'click'
UNION ALL SELECT event_id, k, 'a', event_type, event_type || '+' || user_id FROM e WHERE event_type = 'click'
UNION ALL SELECT event_id, k, 'a', 'x', event_type || '+' || user_id FROM e WHERE event_type = 'click'""",
)
def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(use: str):
        return ForEach(
            lambda n: n.get("names").where("use", use),
            (
                Columns((Col("use", lambda n: n.get("use")),)),
                ForEach(lambda n: n.get("parts"), (Columns((Col("part", lambda n: n),)),)),
            ),
        )

    view = View(
        "nested",
        "Event",
        (
            Columns((Col("id", lambda n: n.get("id"), "string"), Col("k", lambda n: n.get("k"), "integer"))),
            UnionAll((names("a"), names("b"))),
            Columns((Col("firsts", lambda n: n.get("names.parts"), collection=True),)),
        ),
        where=(lambda n: n.get("kind").equals("click"),),
    )
    part = F.from_json("props", "struct<k:int>").getField("k")
    root = F.struct(
        F.col("event_id").alias("id"),
        part.alias("k"),
        F.col("event_type").alias("kind"),
        F.array(
            F.struct(F.lit("a").alias("use"), F.array("event_type", F.lit("x")).alias("parts")),
            F.struct(F.lit("b").alias("use"), F.array(F.col("user_id").cast("string")).alias("parts")),
        ).alias("names"),
    )
    rows = flatten_parsed(M.table(spark, sf_dir, "events").select(root.alias("r")), view, "r", T.DataType.fromDDL(_NESTED))
    joined = F.array_join(F.filter("firsts", lambda x: x != "x"), "+")
    return rows.select(F.col("id").cast("long").alias("id"), "k", "use", "part", joined.alias("joined"))


# --- quality --------------------------------------------------------------------------------------


@register("strict_gate", "WITH line AS (" + LINE.strip()[len("line AS (") : -1] + ") SELECT 'c-' || lid AS id FROM line")
def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QL.strict_gate(M.resources(spark, sf_dir, "Condition"), "Condition__condition_occurrence").select("id")


SQL["strict_gate"] += " WHERE l_returnflag IN ('A', 'N')"


@register(
    "view_descend",
    """
WITH line AS (
  SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_quantity AS BIGINT)) AS depth FROM lineitem)
SELECT 'q' || l_orderkey AS id, 'line ' || l_linenumber AS link, CAST(l_quantity AS BIGINT) AS quantity, depth FROM line
UNION ALL
SELECT 'q' || l_orderkey, 'note ' || l_linenumber, NULL, depth + 1 FROM line WHERE l_linenumber % 2 = 0""",
)
def _descended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as nested questionnaire items, each line within the one before; even lines also have an answer with an item."""
    lines = M.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("quantity")
    )
    own = F.struct("l_linenumber", "quantity")
    # an order has few lines, whatever the size of the table
    orders = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(own), asc=False).alias("lines"))

    def nest(inner: Column, line: Column) -> Column:
        number = line.getField("l_linenumber").cast("string")
        note = F.concat(F.lit(',"answer":[{"item":{"linkId":"note '), number, F.lit('"}}]'))
        return F.concat(
            F.lit('[{"linkId":"line '),
            number,
            F.lit('","quantity":'),
            line.getField("quantity").cast("string"),
            F.when(line.getField("l_linenumber") % 2 == 0, note).otherwise(""),
            F.lit(',"item":'),
            inner,
            F.lit("}]"),
        )

    items = F.aggregate("lines", F.lit("null"), nest)
    resources = orders.select(
        F.lit("QuestionnaireResponse").alias("resource_type"),
        F.concat(F.lit("q"), "l_orderkey").alias("id"),
        F.concat(F.lit('{"resourceType":"QuestionnaireResponse","item":'), items, F.lit("}")).alias("resource"),
    )
    columns = {"link": ("linkId", "string"), "quantity": ("quantity", "bigint")}
    return descend(resources, "QuestionnaireResponse", ["item", "answer.item"], columns).drop("place")


@register(
    "null_profile",
    """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 5 <> 0) AS part_of FROM orders)
SELECT 'id' AS "column", n AS "rows", 0 AS nulls, 0.0::DOUBLE AS null_rate, false AS violation FROM n
UNION ALL SELECT 'part_of_ref', n, part_of, part_of / n::DOUBLE, false FROM n
UNION ALL SELECT 'subject_ref', n, 0, 0.0, false FROM n
UNION ALL SELECT 'type_code', n, n, 1.0, true FROM n""",
)
def _nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = flatten(M.resources(spark, sf_dir, "Encounter"), views.encounter)
    return QL.null_profile(staged, ["subject_ref", "part_of_ref", "type_code"])


@register(
    "duplicate_keys",
    "SELECT l_orderkey || '-' || l_linenumber AS line_key, count(*) AS copies FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return QL.duplicate_keys(rows, "line_key")


@register(
    "row_bag_difference",
    """
WITH a AS (SELECT user_id, event_type, NULL::DOUBLE AS value FROM events),
     b AS (SELECT user_id, CASE WHEN event_id % 10 = 0 THEN 'other' ELSE event_type END AS event_type, NULL::DOUBLE AS value
           FROM events)
SELECT *, 'unexpected' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'missing' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def _bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = M.table(spark, sf_dir, "events")
    actual = events.select("user_id", "event_type", F.lit(None).cast("double").alias("value"))
    other = F.when(F.col("event_id") % 10 == 0, "other").otherwise(F.col("event_type"))
    return QL.row_bag_difference(actual, events.select("user_id", other.alias("event_type")))


@register(
    "misrouted_rows",
    """
SELECT p_partkey AS row_key, count(*) AS branches, min(branch) AS first_branch FROM (
  SELECT p_partkey, 'large' AS branch FROM part WHERE p_size > 20
  UNION ALL SELECT p_partkey, 'small' FROM part WHERE p_size < 30)
GROUP BY 1 HAVING count(*) > 1""",
)
def _misrouted(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = M.table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "row_key")
    return QL.misrouted({"small": part.where("p_size < 30"), "large": part.where("p_size > 20")})


@register(
    "family_routes_disjoint",
    "SELECT CAST(NULL AS VARCHAR) AS row_key, CAST(NULL AS BIGINT) AS branches, CAST(NULL AS VARCHAR) AS first_branch "
    "FROM lineitem WHERE false",
)
def _disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every resolved condition goes to one table only."""
    family = context(spark, sf_dir, "Condition").family("condition", columns=("id",))
    rows = family.withColumn("row_key", F.concat_ws("|", "id", "std_concept_id"))
    domains = ("Condition", "Procedure", "Measurement", "Observation")
    return QL.misrouted({d: V.route(rows, d) for d in domains})


@register(
    "quarantine_required",
    f"""
SELECT {hk("'sp-' || " + M.LINE_ID)} AS specimen_id, 'specimen_date' AS missing
FROM lineitem WHERE l_linenumber = 1""",
)
def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specimens without a date, as they would fail the table's NOT NULL columns."""
    staged = flatten(M.resources(spark, sf_dir, "Specimen"), views.specimen)
    rows = staged.select(
        K.string_id("id").alias("specimen_id"),
        K.string_id("subject_ref").alias("person_id"),
        F.lit(0).alias("specimen_concept_id"),
        F.col("collected_dt").alias("specimen_date"),
    )
    _, bad = QL.split_required(rows, "specimen")
    return bad.select("specimen_id", F.array_join("missing", ",").alias("missing"))
