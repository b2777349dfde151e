"""Surrogate keys: a 60-bit hash of the logical id, so foreign keys need no join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_id(value: Column | str) -> Column:
    """Hash of a string as bigint; NULL and '' have no key."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(text != "", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"))


reference_id = string_id


def coded_id(resource_id: str, concept: str) -> Column:
    """Key of one resource seen as one standard concept."""
    return string_id(F.concat(F.col(resource_id), F.lit("|"), F.col(concept).cast("string")))


def component_id(resource_id: str, code: str, concept: str, family: str = "/") -> Column:
    """Key of a component row. ``family`` keeps the measurement and observation keys apart."""
    return string_id(
        F.concat(
            F.col(resource_id),
            F.lit(family),
            F.coalesce(F.col(code), F.lit("")),
            F.lit("|"),
            F.col(concept).cast("string"),
        )
    )


def address_id(*parts: str) -> Column:
    """Key over the address parts that are present; no part at all gives NULL."""
    return string_id(F.concat_ws("|", *[F.col(p) for p in parts]))
