"""The full run: which edges feed which CDM table, and how the tables are written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.operators import quality
from medloom.plans import edges as E
from medloom.schema import cdm


@dataclass(frozen=True)
class Edge:
    name: str
    target: str
    build: Callable[..., DataFrame]
    mode: str = "append"


# The first edge of a table replaces it, later ones add rows, an update edge rewrites rows of the table so far.
PLAN: list[Edge] = [
    Edge("Practitioner__provider", "provider", E.provider, "truncate"),
    Edge("Organization__care_site", "care_site", E.organization_care_site, "truncate"),
    Edge("Location__care_site", "care_site", E.location_care_site),
    Edge("Patient__location", "location", E.patient_location, "truncate"),
    Edge("Location__location", "location", E.location_location),
    Edge("Patient__person", "person", E.person, "truncate"),
    Edge("Encounter__visit_occurrence", "visit_occurrence", E.visit_occurrence, "truncate"),
    Edge("Condition__condition_occurrence", "condition_occurrence", E.condition_occurrence, "truncate"),
    Edge("Procedure__procedure_occurrence", "procedure_occurrence", E.procedure_occurrence, "truncate"),
    Edge("DiagnosticReport__procedure_occurrence", "procedure_occurrence", E.report_procedure),
    Edge("Condition__procedure_occurrence", "procedure_occurrence", E.condition_procedure),
    Edge("Observation__measurement", "measurement", E.observation_measurement, "truncate"),
    Edge("Observation_component__measurement", "measurement", E.component_measurement),
    Edge("DiagnosticReport__measurement", "measurement", E.report_measurement),
    Edge("Condition__measurement", "measurement", E.condition_measurement),
    Edge("Observation__observation", "observation", E.observation_observation, "truncate"),
    Edge("Observation_component__observation", "observation", E.component_observation),
    Edge("AllergyIntolerance__observation", "observation", E.allergy_observation),
    Edge("DiagnosticReport__observation", "observation", E.report_observation),
    Edge("Condition__observation", "observation", E.condition_observation),
    Edge("DiagnosticReport__note", "note", E.report_note, "truncate"),
    Edge("MedicationRequest__drug_exposure", "drug_exposure", E.medication_request, "truncate"),
    Edge("MedicationAdministration__drug_exposure", "drug_exposure", E.medication_administration),
    Edge("Immunization__drug_exposure", "drug_exposure", E.immunization),
    Edge("MedicationDispense__drug_exposure", "drug_exposure", E.medication_dispense),
    Edge("MedicationStatement__drug_exposure", "drug_exposure", E.medication_statement),
    Edge("Device__device_exposure", "device_exposure", E.device_exposure, "truncate"),
    Edge("Specimen__specimen", "specimen", E.specimen, "truncate"),
    Edge("Patient__death", "death", E.death, "truncate"),
    Edge("Coverage__payer_plan_period", "payer_plan_period", E.payer_plan_period, "truncate"),
    Edge("Patient__observation_period", "observation_period", E.observation_period, "truncate"),
    Edge("PractitionerRole__provider", "provider", E.provider_with_roles, "update"),
]
BY_NAME = {e.name: e for e in PLAN} | {"Medication__drug_exposure": Edge("Medication__drug_exposure", "drug_exposure", E.medication)}


def run_edge(ctx: E.Context, name: str) -> DataFrame:
    """The rows of one edge, lazily; nothing is written."""
    return BY_NAME[name].build(ctx)


def build_tables(ctx: E.Context, only: set[str] | None = None) -> dict[str, DataFrame]:
    """Every CDM table as one lazy union of its edges."""
    parts: dict[str, list[DataFrame]] = {}
    for edge in PLAN:
        if only is not None and edge.name not in only:
            continue
        if edge.mode == "update":
            base = reduce(DataFrame.unionByName, parts.get(edge.target, [E.provider(ctx)]))
            parts[edge.target] = [edge.build(ctx, base)]
        elif edge.mode == "truncate":
            parts[edge.target] = [edge.build(ctx)]
        else:
            parts.setdefault(edge.target, []).append(edge.build(ctx))
    return {table: reduce(DataFrame.unionByName, dfs) for table, dfs in parts.items()}


def write_table(df: DataFrame, table: str, path: str) -> list[tuple]:
    """Write one table to ``path/table`` and its bad rows to ``path/_quarantine/table``; return the profile of all rows.

    The rows are computed once: one write parts them by what they lack and counts NULLs and text lengths on the way, then the
    finished folders move to their places. Only the quarantined rows are written a second time, with their reasons as a list.
    Rows of earlier runs are replaced when the write has succeeded. On object stores a move is a copy within the store.
    """
    spark = df.sparkSession
    seen = Observation()
    reason = F.array_join(quality.missing_required(table), ",")
    marked = df.observe(seen, *quality.profile_metrics(df)).withColumn("missing", F.nullif(reason, F.lit("")))
    staged = f"{path}/_staged/{table}"
    marked.write.mode("overwrite").partitionBy("missing").parquet(staged)

    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{path}/{table}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("missing", T.StringType())])).parquet(staged)
    bad = parts.where("missing is not null").withColumn("missing", F.split("missing", ","))
    bad.write.mode("overwrite").parquet(f"{path}/_quarantine/{table}")
    good = hadoop.Path(f"{staged}/missing=__HIVE_DEFAULT_PARTITION__")
    if system.exists(good):
        system.delete(target, True)
        if not system.rename(good, target):
            raise OSError(f"cannot move {good} to {target}")
    else:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/{table}")
    system.delete(hadoop.Path(staged), True)
    return quality.profile_rows(table, df.columns, seen.get)


def write_tables(ctx: E.Context, path: str, strict: bool = False, only: set[str] | None = None) -> DataFrame:
    """Write every table, each computed once, bad rows to ``_quarantine``, and return the key report.

    The Maps-to table, families and views that feed several tables are materialised once. ``strict`` turns the
    required-element gate on. ``_profile`` holds rows, NULLs and longest texts of every column as they came out of the edges.
    """
    ctx.materialize = True
    ctx.vocabulary = ctx.vocabulary.materialized()
    if strict:
        ctx.gate = quality.strict_gate
    spark = ctx.resources.sparkSession
    written: dict[str, DataFrame] = {}
    profile: list[tuple] = []
    for table, df in build_tables(ctx, only).items():
        profile += write_table(df, table, path)
        written[table] = spark.read.schema(cdm.schema(table)).parquet(f"{path}/{table}")
    spark.createDataFrame(profile, quality.PROFILE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/_profile")
    return quality.key_report(written)
