"""FHIR bundles to raw resource rows: ``(resource_type, id, resource)`` with latest-wins upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.joins import first_per_group

_BUNDLE = "array<struct<resourceType:string,id:string,entry:array<struct<resource:string>>>>"
_HEAD = "struct<resourceType:string,id:string>"


def table_name(resource_type: Column) -> Column:
    """MedicationRequest -> medication_request."""
    split = F.regexp_replace(resource_type, "([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.regexp_replace(split, "([A-Z]+)([A-Z][a-z])", "$1_$2"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file; the file time orders repeated loads."""
    return spark.read.text(path, wholetext=True).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("loaded_at"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of exports that hold one resource or bundle a line; large files are split between tasks.

    ``line`` orders the lines of a file: the start of the split, then the place in it.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("loaded_at"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("line"),
    )
    return lines.where(F.trim("value") != "")


def _item(resource_type: Column, id_: Column, resource: Column) -> Column:
    return F.struct(
        F.nullif(resource_type, F.lit("")).alias("resource_type"), F.nullif(id_, F.lit("")).alias("id"), resource.alias("resource")
    )


def _parsed_item(resource: Column) -> Column:
    head = [F.try_variant_get(resource, f"$.{name}", "string") for name in ("resourceType", "id")]
    return _item(*head, F.to_json(resource))


def _text_item(resource: Column) -> Column:
    head = F.from_json(resource, _HEAD)
    return _item(head.getField("resourceType"), head.getField("id"), resource)


def entries(files: DataFrame) -> DataFrame:
    """Resources of bundles, or a bare resource, one row each, with their place in the file.

    ``resource_type`` or ``id`` is NULL for entries that count as skipped, empty ones included. A text that is not one JSON value
    (NULL, blank, broken, more behind the value) or a bundle whose entries are no list gives one row with ``broken`` set, and
    never stops the other files. Each text is parsed once. What the Variant parser refuses although it is JSON (a doubled name,
    a text above its size limit) is read as text instead.
    """
    others = [c for c in files.columns if c != "value"]
    # With a zero behind it in brackets, anything but one value is an error or a list of another length.
    wrapped = F.concat(F.lit("["), "value", F.lit(",0]"))
    # One-element explodes: each step is evaluated once, however often its column is used.
    parsed = files.select(*others, "value", F.explode(F.array(F.try_parse_json(wrapped))).alias("_list"))
    one = F.try_variant_get("_list", "$[0]", "variant")
    alone = F.try_variant_get("_list", "$[1]", "int").isNotNull() & F.try_variant_get("_list", "$[2]", "variant").isNull()
    plain = F.when(F.col("_list").isNull(), F.from_json(F.concat(F.lit("["), "value", F.lit("]")), _BUNDLE))
    parsed = parsed.select(*others, "value", F.explode(F.array(F.struct(F.when(alone, one).alias("v"), plain.alias("t")))).alias("_p"))

    none = F.array().cast("array<struct<resource_type:string,id:string,resource:string>>")
    value, text = F.col("_p.v"), F.col("_p.t")
    entry = F.try_variant_get(value, "$.entry", "array<variant>")
    raw_entry = F.try_variant_get(value, "$.entry", "variant")
    resource_of = lambda e: _parsed_item(F.try_variant_get(e, "$.resource", "variant"))
    is_bundle = F.try_variant_get(value, "$.resourceType", "string").eqNullSafe("Bundle")
    of_bundle = (
        F.when(entry.isNotNull(), F.transform(entry, resource_of))
        .when(raw_entry.isNull() | F.is_variant_null(raw_entry), none)
    )
    of_value = F.when(is_bundle, of_bundle).otherwise(F.array(_parsed_item(value)))
    first = F.try_element_at(text, F.lit(1))
    of_text = F.when(
        first.getField("resourceType").eqNullSafe("Bundle"),
        F.coalesce(F.transform(first.getField("entry"), lambda e: _text_item(e.getField("resource"))), none),
    ).otherwise(F.array(_text_item(F.col("value"))))
    items = F.when(value.isNotNull(), of_value).when(F.size(text) == 1, of_text)
    rows = parsed.select(*others, "value", F.explode(F.array(items)).alias("_items"))
    broken = _item(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("value"))
    rows = rows.select(
        *others,
        F.col("_items").isNull().alias("broken"),
        F.posexplode(F.coalesce("_items", F.array(broken))).alias("position", "_e"),
    )
    return rows.select("_e.resource_type", "_e.id", "_e.resource", *others, "position", "broken")


def loadable(rows: DataFrame) -> DataFrame:
    return rows.where("NOT broken AND resource_type IS NOT NULL AND id IS NOT NULL")


def load_counts(rows: DataFrame) -> DataFrame:
    """Per resource type how many entries were taken, skipped or broken."""
    taken = F.col("resource_type").isNotNull() & F.col("id").isNotNull() & ~F.col("broken")
    return rows.groupBy("resource_type").agg(
        F.count_if(taken).alias("inserted"),
        F.count_if(~taken & ~F.col("broken")).alias("skipped"),
        F.count_if("broken").alias("broken_files"),
    )


def latest(rows: DataFrame, *order: Column) -> DataFrame:
    """The last version of each resource. The order is (load time, file, place in the file) by default."""
    order = order or tuple(F.desc(c) for c in ("loaded_at", "file", "line", "position") if c in rows.columns)
    return first_per_group(rows, ["resource_type", "id"], list(order))


def upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """``current`` with the incoming resources replacing those of the same type and id."""
    columns = ["resource_type", "id", "resource"]
    kept = current.join(incoming.select("resource_type", "id"), ["resource_type", "id"], "left_anti")
    return kept.select(*columns).unionByName(incoming.select(*columns))


def load(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Latest resources of a file or folder of bundles; with ``lines`` every line is a resource or bundle of its own."""
    files = read_lines(spark, path) if lines else read_files(spark, path)
    return latest(loadable(entries(files))).select("resource_type", "id", "resource")


def write_raw(resources: DataFrame, path: str) -> None:
    """One folder per resource type, so that an edge reads only its own type."""
    resources.write.mode("overwrite").partitionBy("resource_type").parquet(path)
