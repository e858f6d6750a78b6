"""Exact quantiles of many columns at any size, by narrowing a bracket of values around each wanted rank.

A mergeable sketch is only right to a share of the rows. Here it proposes two values of the column around a wanted
rank, one pass counts the rows below and between them, and the next sketch is of those between only, so every
round leaves about one row in a thousand. Rounds end at a single value, however often it occurs, or at few enough
rows to sort. All columns and ranks share each round's one aggregation, and the driver holds two values for each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
SORTED_ROWS = 4096  # so many values of a column are sorted at once
PARTS = ("below", "low", "between", "high", "above")


@dataclass
class Bracket:
    """Where a wanted rank lies: ``rank`` counts from 1 among the ``rows`` values from ``low`` to ``high``."""

    column: str
    fraction: float
    rank: int
    rows: int
    low: Any
    high: Any
    found: Any = None

    @property
    def value(self) -> Column:
        return F.col(f"`{self.column}`")

    @property
    def within(self) -> Column:
        return self.value.between(F.lit(self.low), F.lit(self.high))

    def settle(self) -> bool:
        """Whether the value is known; it is where the bracket holds one value only."""
        if self.found is None and self.rows and (self.low == self.high or math.isnan(self.low)):
            self.found = self.low
        return self.found is not None or not self.rows


def _first_brackets(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> list[Bracket]:
    parts = []
    for k, name in enumerate(columns):
        value = F.col(f"`{name}`")
        parts += [F.count(value).alias(f"n{k}"), F.min(value).alias(f"low{k}"), F.max(value).alias(f"high{k}")]
    row = df.agg(*parts).first()
    brackets = []
    for k, name in enumerate(columns):
        for fraction in fractions:
            wanted = Fraction(str(fraction)) * row[f"n{k}"]
            rank = max(1, -(-wanted.numerator // wanted.denominator))
            brackets.append(Bracket(name, fraction, rank, row[f"n{k}"], row[f"low{k}"], row[f"high{k}"]))
    return brackets


def _pick(df: DataFrame, brackets: list[Bracket]) -> None:
    """The wanted values of brackets with few rows."""
    listed = [
        F.element_at(F.sort_array(F.collect_list(F.when(b.within, b.value))), b.rank).alias(f"v{k}")
        for k, b in enumerate(brackets)
    ]
    row = df.agg(*listed).first()
    for k, b in enumerate(brackets):
        b.found = row[f"v{k}"]


def _narrow(df: DataFrame, brackets: list[Bracket], accuracy: int) -> None:
    """Each bracket replaced by the part of it that has the rank, cut at two values near that rank.

    The values equal to a cut are a part of their own, so that each round leaves fewer rows or a single value.
    """
    sketches = []
    for k, b in enumerate(brackets):
        at = [min(1.0, max(0.0, b.rank / b.rows + side * 2 / accuracy)) for side in (-1, 1)]
        sketches.append(F.percentile_approx(F.when(b.within, b.value), at, accuracy).alias(f"cuts{k}"))
    cuts = df.agg(*sketches).first()
    counts = []
    for k, b in enumerate(brackets):
        low, high = (F.lit(cut) for cut in cuts[f"cuts{k}"])
        inner = (b.value > low) & (b.value < high)
        parts = [b.value < low, b.value == low, inner, (b.value == high) & (low != high), b.value > high]
        for name, part in zip(PARTS, parts):
            inside = F.when(b.within & part, b.value)
            counts.append(F.struct(F.count(inside), F.min(inside), F.max(inside)).alias(f"{name}{k}"))
    row = df.agg(*counts).first()
    for k, b in enumerate(brackets):
        for name in PARTS:
            rows, low, high = row[f"{name}{k}"]
            if b.rank <= rows:
                b.rows, b.low, b.high = rows, low, high
                break
            b.rank -= rows


def quantile_values(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    accuracy: int = ACCURACY,
    sorted_rows: int = SORTED_ROWS,
) -> dict[tuple[str, float], float | None]:
    """The values of :func:`exact_quantiles` by column and fraction."""
    names = list(dict.fromkeys(columns))
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    brackets = _first_brackets(numbers, names, fractions) if names and fractions else []
    while open_ones := [b for b in brackets if not b.settle()]:
        few = [b for b in open_ones if b.rows <= sorted_rows]
        if few:
            _pick(numbers, few)
        many = [b for b in open_ones if b.rows > sorted_rows]
        if many:
            _narrow(numbers, many, accuracy)
    return {(b.column, b.fraction): b.found for b in brackets}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    accuracy: int = ACCURACY,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """``(column, fraction, value)``: the smallest value that at least that fraction of the values do not exceed.

    That is SQL's ``quantile_disc``, as a double. NULLs do not count; NaN counts as the largest value, as in Spark's
    order. A column without values has NULL. Each round reads the columns twice and shuffles one row for each task;
    ``df`` should be a stored table, as it is read several times. ``sorted_rows`` and ``accuracy`` change the
    number of rounds only.
    """
    found = quantile_values(df, columns, fractions, accuracy, sorted_rows)
    rows = [(column, float(fraction), value) for (column, fraction), value in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, fraction double, value double")
