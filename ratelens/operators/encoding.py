"""Indicator columns for categories and comma lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import comma_list, feature_name


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)  # a NULL condition gives 0


def list_indicators(
    column: Column, labels: Sequence[str], prefix: str, mode: str = "substring", ignore_case: bool = False
) -> list[Column]:
    """One 0/1 column per label found in a comma list.

    ``substring`` also finds a label inside a longer token; ``exact`` compares whole tokens.
    """
    text = F.lower(column) if ignore_case else column
    tokens = comma_list(text)

    def found(label: str) -> Column:
        wanted = label.lower() if ignore_case else label
        return F.array_contains(tokens, wanted) if mode == "exact" else text.contains(wanted)

    return [_flag(found(label)).alias(feature_name(prefix, label)) for label in labels]


def category_indicators(column: Column, labels: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per category; unseen categories and NULL give all zeros."""
    return [_flag(column == label).alias(feature_name(prefix, label)) for label in labels]


def encode(df: DataFrame, *indicator_lists: Sequence[Column]) -> DataFrame:
    """The table with all indicators added by a single projection."""
    return df.select("*", *[c for group in indicator_lists for c in group])
