"""Tolerant typing: a value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ("d/M/yyyy",)


def to_double(text: Column, units: Sequence[str] = ()) -> Column:
    """Number with an optional trailing unit, e.g. '138 kV'."""
    bare = F.trim(text)
    if units:
        bare = F.regexp_replace(bare, r"\s*(?:" + "|".join(units) + r")$", "")
    return bare.try_cast("double")


def to_int(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def to_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """ISO first, then the given formats in order. Day comes before month by default."""
    bare = F.trim(text)
    return F.coalesce(
        bare.try_cast("date"), *[F.try_to_date(bare, fmt) for fmt in formats]
    )


def typed(text: Column, kind: str, units: Sequence[str] = (), formats: Sequence[str] = DATE_FORMATS) -> Column:
    if kind == "double":
        return to_double(text, units)
    if kind == "int":
        return to_int(text)
    if kind == "date":
        return to_date(text, formats)
    if kind == "string":
        return text
    raise ValueError(f"no typing rule for {kind}")


def variant_first(variant: Column, paths: Sequence[str], kind: str) -> Column:
    """First path of a VARIANT that holds a value of the kind."""
    return F.coalesce(*[F.try_variant_get(variant, path, kind) for path in paths])
