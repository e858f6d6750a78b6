"""Tolerant typing: text that does not parse becomes NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_whole(column: Column, kind: str = "int") -> Column:
    """Whole number from ``12`` as well as ``12.0``; a value with a fraction is none."""
    number = column.try_cast("double")
    whole = F.coalesce(column.try_cast(kind), number.try_cast(kind))
    return F.when(number.isNull() | (number == F.rint(number)), whole)


def to_known_whole(column: Column, unknown: str = "Unknown", kind: str = "int") -> Column:
    """Whole number, with the ``unknown`` marker and other text as NULL."""
    return F.when(column != unknown, to_whole(column, kind))


def iso_date(column: Column) -> Column:
    """Date part of ISO date-time text such as ``2011-01-10T00:00:00+00:00``."""
    return F.try_to_date(F.split_part(column, F.lit("T"), F.lit(1)), "yyyy-MM-dd")


def typed(column: Column, kind: str) -> Column:
    """Cast raw text to ``kind`` (string, date, double, int, bigint) without ever failing."""
    if kind == "string":
        return column
    if kind == "date":
        return iso_date(column)
    if kind in ("int", "bigint"):
        return to_whole(column, kind)
    return column.try_cast(kind)
