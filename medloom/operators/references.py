"""Search references (``Type?identifier=system|value``) to direct ones (``Type/id``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.operators.joins import keyed_join, lookup_join

# Identifier system per resource type that may be searched for, and the types that search.
IDENTIFIER_SYSTEMS = {
    "Practitioner": "http://hl7.org/fhir/sid/us-npi",
    "Organization": "https://github.com/synthetichealth/synthea",
    "Location": "https://github.com/synthetichealth/synthea",
}
SEARCHING_TYPES = (
    "Encounter Procedure MedicationRequest MedicationAdministration Immunization DiagnosticReport Observation "
    "Condition AllergyIntolerance Device Patient"
).split()
_SEARCH = r'"reference"\s*:\s*"([^"]*\?identifier=[^"]*)"'


def identifier_index(resources: DataFrame) -> DataFrame:
    """``(search, direct, owners)``: the lowest id owns an identifier, ``owners`` shows doubled ones."""
    kinds = F.create_map(*[F.lit(x) for kv in IDENTIFIER_SYSTEMS.items() for x in kv])
    rows = resources.where(F.col("resource_type").isin(*IDENTIFIER_SYSTEMS)).select(
        "resource_type",
        "id",
        F.explode(
            F.from_json("resource", "struct<identifier:array<struct<system:string,value:string>>>").getField("identifier")
        ).alias("i"),
    )
    rows = rows.where((F.col("i.system") == kinds[F.col("resource_type")]) & (F.col("i.value") != ""))
    search = F.concat("resource_type", F.lit("?identifier="), "i.system", F.lit("|"), "i.value")
    return (
        rows.groupBy(search.alias("search"), "resource_type")
        .agg(F.min("id").alias("id"), F.count_distinct("id").alias("owners"))
        .select("search", F.concat("resource_type", F.lit("/"), "id").alias("direct"), "owners")
    )


def duplicate_identifiers(index: DataFrame) -> DataFrame:
    return index.where("owners > 1")


def _searches() -> Column:
    test = F.col("resource_type").isin(*SEARCHING_TYPES) & F.col("resource").contains("?identifier=")
    return F.coalesce(test, F.lit(False))


def found_references(resources: DataFrame, index: DataFrame) -> DataFrame:
    """Every resolvable search reference of every resource."""
    refs = F.array_distinct(F.regexp_extract_all("resource", F.lit(_SEARCH), 1))
    rows = resources.where(_searches()).select("resource_type", "id", F.explode(refs).alias("search"))
    return lookup_join(rows, index.select("search", "direct"), ["search"], "inner")


def count_resolvable(resources: DataFrame, index: DataFrame) -> DataFrame:
    """Dry run: rows and references that would change, per type."""
    return found_references(resources, index).groupBy("resource_type").agg(
        F.count_distinct("id").alias("rows"), F.count(F.lit(1)).alias("references")
    )


def resolve_references(resources: DataFrame, index: DataFrame) -> DataFrame:
    """Resources with direct references, wherever in the resource they stand. Repeating it changes nothing."""
    # The list holds the references of one resource, so it is as bounded as the resource.
    found = (
        found_references(resources, index)
        .groupBy("resource_type", "id")
        .agg(F.collect_list(F.struct("search", "direct")).alias("_swap"))
    )
    # Only resources that search are shuffled; all others pass through.
    joined = keyed_join(resources.where(_searches()), found, ["resource_type", "id"], "left")
    quoted = F.lit('"')
    swapped = F.reduce(
        F.coalesce("_swap", F.array().cast("array<struct<search:string,direct:string>>")),
        F.col("resource"),
        lambda text, s: F.replace(
            text, F.concat(quoted, s.getField("search"), quoted), F.concat(quoted, s.getField("direct"), quoted)
        ),
    )
    changed = joined.withColumn("resource", swapped).select(*resources.columns)
    return resources.where(~_searches()).unionByName(changed)
