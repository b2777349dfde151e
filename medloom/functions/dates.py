"""The two clock rules: keep the wall clock as written, or rebase to UTC."""

from __future__ import annotations

from pyspark.sql import Column


def wall_date(text: Column) -> Column:
    return text.try_cast("date")


def wall_datetime(text: Column) -> Column:
    """The offset is dropped and the local reading kept."""
    return text.try_cast("timestamp_ntz")


def utc_datetime(text: Column) -> Column:
    """The instant in UTC; needs ``spark.sql.session.timeZone`` UTC, as every session here has."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def utc_date(text: Column) -> Column:
    return utc_datetime(text).cast("date")
