"""Named validity rules for category texts coming out of shifted CSV rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age ratings accepted by the report (prefix patterns) and texts known to be misplaced.
AGE_RATING_ALLOWED = (
    r"^G - All Ages",
    r"^PG - Children",
    r"^PG-13 - Teens",
    r"^R - 17\+",
    r"^R\+ - Mild",
    r"^Rx - Hentai",
    r"^UNKNOWN$|^Unknown$|^None$",
)
AGE_RATING_DENIED = (
    r"^\d+(\.\d+)?$",
    r"^https?://",
    r"min|hr",
    r"^(fall|spring|summer|winter)",
    r"^(Bandai|Madhouse|Bee Train|Trans Arts|ORADA|ADV)",
)
URL_PATTERN = r"^https?://"


def valid_category(column: Column, allow: Sequence[str], deny: Sequence[str], max_length: int) -> Column:
    """Text shorter than ``max_length`` that matches an allowed pattern and no denied one."""
    denied = reduce(Column.__or__, [column.rlike(p) for p in deny])
    allowed = reduce(Column.__or__, [column.rlike(p) for p in allow])
    return column.isNotNull() & ~denied & allowed & (F.length(column) < max_length)


def valid_age_rating(column: Column) -> Column:
    return valid_category(column, AGE_RATING_ALLOWED, AGE_RATING_DENIED, 50)


def valid_studio(column: Column) -> Column:
    """No URL, under 150 characters, and over 100 only as a comma list."""
    size = F.length(column)
    return column.isNotNull() & ~column.rlike(URL_PATTERN) & (size < 150) & ((size <= 100) | column.contains(","))
