"""Quality operators: required elements, null rates, key uniqueness, row-bag comparison, routing checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.plans.profiles import REQUIRED_ELEMENTS
from medloom.schema import cdm


def has_element(resource: Column, path: str) -> Column:
    """Whether a JSON object has the element; ``name[x]`` accepts any element that starts with the name."""
    *parents, last = path.split(".")
    holder = F.get_json_object(resource, "$." + ".".join(parents)) if parents else resource
    names = F.json_object_keys(holder)
    if last.endswith("[x]"):
        found = F.exists(names, lambda n: n.startswith(last[:-3]))
    else:
        found = F.array_contains(names, last)
    return F.coalesce(found, F.lit(False))


def required_elements(resources: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Rows with every required element; no paths keep every row."""
    tests = [has_element(F.col("resource"), p) for p in paths]
    return resources.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def strict_gate(resources: DataFrame, edge: str) -> DataFrame:
    """Gate of an edge, to be applied before its view flattens the resources."""
    kind = edge.split("__")[0].split("_")[0]
    return required_elements(resources.where(F.col("resource_type") == kind), REQUIRED_ELEMENTS.get(edge, []))


def null_profile(df: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """Rows, NULLs and NULL rate per column from one pass.

    A NULL key is a violation, and so is a reference column that is always NULL; others only inform.
    """
    names = [c for c in [key, *columns] if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in names])
    rows = counts.select("n", F.explode(entries).alias("e")).select("e.column", F.col("n").alias("rows"), "e.nulls")
    bad = F.when(F.col("column") == key, F.col("nulls") > 0).otherwise(F.col("nulls") == F.col("rows"))
    return rows.where("rows > 0").select(
        "*", (F.col("nulls") / F.col("rows")).alias("null_rate"), bad.alias("violation")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table how many keys are doubled."""
    parts = [
        duplicate_keys(df, cdm.primary_key(name)).agg(F.count(F.lit(1)).alias("duplicate_keys")).select(
            F.lit(name).alias("table"), "duplicate_keys"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_required(table: str) -> Column:
    """Names of the NOT NULL columns of a table that a row leaves NULL, in the order of the table's rules."""
    names = [cdm.primary_key(table), *cdm.REQUIRED.get(table, [])]
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in names]), lambda x: x.isNotNull())


def split_required(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the NOT NULL columns of a table, and the others with the reason."""
    marked = df.withColumn("missing", missing_required(table))
    good = marked.where(F.size("missing") == 0).drop("missing")
    return good, marked.where(F.size("missing") > 0)


def profile_metrics(df: DataFrame) -> list[Column]:
    """Aggregates for ``DataFrame.observe``: rows, NULLs of each column and the longest text of each text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls {c}") for c in df.columns],
        *[F.max(F.length(c)).alias(f"longest {c}") for c in texts],
    ]


def profile_rows(table: str, columns: Sequence[str], metrics: dict) -> list[tuple]:
    """Observed metrics as (table, column, rows, nulls, null_rate, violation, longest), judged as :func:`null_profile` does."""
    rows, key, out = metrics["rows"], cdm.primary_key(table), []
    for c in columns if rows else ():
        nulls = metrics[f"nulls {c}"]
        out.append((table, c, rows, nulls, nulls / rows, nulls > 0 if c == key else nulls == rows, metrics.get(f"longest {c}")))
    return out


PROFILE_SCHEMA = "table string, column string, rows long, nulls long, null_rate double, violation boolean, longest int"


def row_bag_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other. A column that ``expected`` lacks must be NULL."""
    names = actual.columns
    filled = expected.select(
        *[
            (F.col(c) if c in expected.columns else F.lit(None)).cast(actual.schema[c].dataType).alias(c)
            for c in names
        ]
    )
    left, right = actual.select(*names), filled
    extra = left.exceptAll(right).withColumn("side", F.lit("unexpected"))
    missing = right.exceptAll(left).withColumn("side", F.lit("missing"))
    return extra.unionByName(missing)


def misrouted(branches: dict[str, DataFrame], key: str = "row_key") -> DataFrame:
    """Rows that more than one branch of a family took. ``branches`` hold one key column each.

    A key's set of branches has as many names as there are branches at most, so keys are shuffled once.
    """
    parts = [df.select(F.col(key)).withColumn("branch", F.lit(name)) for name, df in branches.items()]
    rows = reduce(DataFrame.unionByName, parts)
    taken = rows.groupBy(key).agg(F.collect_set("branch").alias("names")).where(F.size("names") > 1)
    return taken.select(key, F.size("names").cast("long").alias("branches"), F.array_min("names").alias("first_branch"))
