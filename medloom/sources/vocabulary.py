"""Vocabulary bundles (tab separated, unquoted) and vaccine code lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medloom.operators.terminology import Vocabulary

# Columns of the vocabulary files and their types; dates are written yyyyMMdd.
FILES: dict[str, list[tuple[str, str]]] = {
    "vocabulary": [
        ("vocabulary_id", "string"),
        ("vocabulary_name", "string"),
        ("vocabulary_reference", "string"),
        ("vocabulary_version", "string"),
        ("vocabulary_concept_id", "int"),
    ],
    "domain": [
        ("domain_id", "string"),
        ("domain_name", "string"),
        ("domain_concept_id", "int"),
    ],
    "concept_class": [
        ("concept_class_id", "string"),
        ("concept_class_name", "string"),
        ("concept_class_concept_id", "int"),
    ],
    "concept": [
        ("concept_id", "int"),
        ("concept_name", "string"),
        ("domain_id", "string"),
        ("vocabulary_id", "string"),
        ("concept_class_id", "string"),
        ("standard_concept", "string"),
        ("concept_code", "string"),
        ("valid_start_date", "date"),
        ("valid_end_date", "date"),
        ("invalid_reason", "string"),
    ],
    "relationship": [
        ("relationship_id", "string"),
        ("relationship_name", "string"),
        ("is_hierarchical", "string"),
        ("defines_ancestry", "string"),
        ("reverse_relationship_id", "string"),
        ("relationship_concept_id", "int"),
    ],
    "concept_relationship": [
        ("concept_id_1", "int"),
        ("concept_id_2", "int"),
        ("relationship_id", "string"),
        ("valid_start_date", "date"),
        ("valid_end_date", "date"),
        ("invalid_reason", "string"),
    ],
    "concept_synonym": [
        ("concept_id", "int"),
        ("concept_synonym_name", "string"),
        ("language_concept_id", "int"),
    ],
    "concept_ancestor": [
        ("ancestor_concept_id", "int"),
        ("descendant_concept_id", "int"),
        ("min_levels_of_separation", "int"),
        ("max_levels_of_separation", "int"),
    ],
    "drug_strength": [
        ("drug_concept_id", "int"),
        ("ingredient_concept_id", "int"),
        ("amount_value", "decimal(38,10)"),
        ("amount_unit_concept_id", "int"),
        ("numerator_value", "decimal(38,10)"),
        ("numerator_unit_concept_id", "int"),
        ("denominator_value", "decimal(38,10)"),
        ("denominator_unit_concept_id", "int"),
        ("box_size", "int"),
        ("valid_start_date", "date"),
        ("valid_end_date", "date"),
        ("invalid_reason", "string"),
    ],
}
CVX_CONCEPT_BASE = 2_000_000_000


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One vocabulary file. Quotes are plain characters; an empty field is NULL."""
    raw = spark.read.csv(
        f"{folder}/{table.upper()}.csv",
        schema=", ".join(f"{name} string" for name, _ in FILES[table]),
        sep="\t",
        header=True,
        quote="",
        emptyValue="",
        nullValue="",
        enforceSchema=True,
    )
    out = []
    for name, kind in FILES[table]:
        column = F.nullif(F.col(name), F.lit(""))
        column = F.to_date(column, "yyyyMMdd") if kind == "date" else column.cast(kind)
        out.append(column.alias(name))
    return raw.select(*out)


def read_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables whose file is there; missing files are skipped."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    out = {}
    for table in FILES:
        path = hadoop(f"{folder}/{table.upper()}.csv")
        if path.getFileSystem(conf).exists(path):
            out[table] = read_table(spark, folder, table)
    return out


def write_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """Columnar copies. Concepts are laid out by code and relationships by source, as the lookups read them."""
    sort = {"concept": ["vocabulary_id", "concept_code"], "concept_relationship": ["relationship_id", "concept_id_1"]}
    for name, df in tables.items():
        if name in sort:
            df = df.repartitionByRange(*sort[name]).sortWithinPartitions(*sort[name])
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> Vocabulary:
    return Vocabulary(
        *[spark.read.parquet(f"{path}/{t}") for t in ("concept", "concept_relationship", "concept_ancestor")]
    )


def cvx_concepts(lines: DataFrame, today: dt.date | None = None, column: str = "value", order: str = "position") -> DataFrame:
    """Concept rows of a pipe separated vaccine list, ids counting up in file order.

    ``order`` holds the line number. The list has a few hundred lines, so one window over it is fine.
    """
    today = today or dt.date.today()
    part = F.transform(F.split(F.col(column), "\\|"), lambda x: F.trim(x))
    rows = lines.select(part.alias("_p"), F.col(order).alias("_o")).where(F.size("_p") >= 6)

    def at(i: int):
        return F.get("_p", F.lit(i))

    rows = rows.where(at(0).rlike("^[0-9]+$"))
    number = F.row_number().over(Window.orderBy("_o")) - 1
    active = at(4) == "Active"
    day = F.coalesce(F.nullif(at(6), F.lit("")), F.lit("2000/01/01"))
    return rows.select(
        (F.lit(CVX_CONCEPT_BASE) + number).cast("int").alias("concept_id"),
        F.substring(at(2), 1, 255).alias("concept_name"),
        F.lit("Drug").alias("domain_id"),
        F.lit("CVX").alias("vocabulary_id"),
        F.lit("CVX").alias("concept_class_id"),
        F.lit(None).cast("string").alias("standard_concept"),
        at(0).alias("concept_code"),
        F.to_date(day, "yyyy/MM/dd").alias("valid_start_date"),
        F.when(active, F.lit(dt.date(2099, 12, 31))).otherwise(F.lit(today)).alias("valid_end_date"),
        F.when(~active, F.lit("D")).alias("invalid_reason"),
    )


def read_cvx(spark: SparkSession, path: str, today: dt.date | None = None) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\r?\n")).alias("position", "value"))
    return cvx_concepts(lines.where(F.trim("value") != ""), today)


def add_cvx(concept: DataFrame, cvx: DataFrame, force: bool = False) -> DataFrame:
    """Add the vaccine concepts once; ``force`` replaces those already there."""
    have = concept.where("vocabulary_id = 'CVX'")
    if not force and have.limit(1).count():
        return concept
    return concept.where("vocabulary_id <> 'CVX'").unionByName(cvx.select(*concept.columns))
