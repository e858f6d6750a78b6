"""Numbers and lists held in free text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def feature_name(prefix: str, label: str) -> str:
    """Column name for a category: lower case, ``+`` spelled out, other symbols as one underscore."""
    slug = re.sub(r"[^0-9a-z]+", "_", label.lower().replace("+", "plus")).strip("_")
    return f"{prefix}_{slug}"


def comma_list(column: Column) -> Column:
    """Trimmed, non-empty tokens of a comma-separated list."""
    tokens = F.transform(F.split(column, ","), lambda token: F.trim(token))
    return F.filter(tokens, lambda token: F.length(token) > 0)


def duration_minutes(column: Column) -> Column:
    """``1 hr 30 min per ep`` -> 90, ``24 min`` -> 24, ``2 hr`` -> 120, no such unit -> NULL."""
    hours = F.regexp_extract(column, r"(\d+)\s*hr", 1).try_cast("int")
    minutes = F.regexp_extract(column, r"(\d+)\s*min", 1).try_cast("int")
    total = F.coalesce(hours, F.lit(0)) * 60 + F.coalesce(minutes, F.lit(0))
    return F.when(hours.isNotNull() | minutes.isNotNull(), total)


def year_in_text(column: Column, which: str = "last") -> Column:
    """The last (or first) run of four digits as a year."""
    patterns = {"last": r".*(\d{4})", "first": r"(\d{4})"}
    return F.regexp_extract(column, patterns[which], 1).try_cast("int")
