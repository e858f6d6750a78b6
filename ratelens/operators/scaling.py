"""Median imputation and min-max scaling, fitted for all columns together.

A fit is a one-row table with a struct ``fit``. Applying it reads that row as a scalar subquery, so the
plan stays lazy and the fitted row can be written and reused on other data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.operators.quantiles import quantile_values
from ratelens.session import stored


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def fit_columns(
    df: DataFrame, medians: Sequence[str] = (), bounds: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Medians of some columns and minimum and maximum of others.

    Medians are exact (``quantile_disc``), for which their columns are stored and read a few times. Bounds are one
    aggregation.
    """
    parts = []
    if medians:
        names = list(dict.fromkeys(medians))
        numbers = stored(df.select(*[_quoted(c) for c in names]), "to-fit")
        found, kinds = quantile_values(numbers, names, [0.5], accuracy), dict(numbers.dtypes)
        parts = [F.lit(found[c, 0.5]).cast(kinds[c]).alias(f"median {c}") for c in medians]
    for c in bounds:
        value = _quoted(c).cast("double")
        parts += [F.min(value).alias(f"min {c}"), F.max(value).alias(f"max {c}")]
    return df.agg(F.struct(*parts).alias("fit"))


def impute(df: DataFrame, columns: Sequence[str], fit: DataFrame) -> DataFrame:
    """NULLs of the columns replaced by their fitted medians."""
    filled = {c: F.coalesce(_quoted(c), F.col("__fit")[f"median {c}"]) for c in columns}
    return df.withColumn("__fit", fit.scalar()).withColumns(filled).drop("__fit")


def scale(df: DataFrame, columns: Sequence[str], outputs: Sequence[str], fit: DataFrame) -> DataFrame:
    """(x - min) / (max - min) in the output columns; a constant column gives 0.0, NULL stays NULL."""
    scaled = {}
    for c, output in zip(columns, outputs):
        value = _quoted(c).cast("double")
        low, high = F.col("__fit")[f"min {c}"], F.col("__fit")[f"max {c}"]
        scaled[output] = F.when(high == low, F.when(value.isNotNull(), 0.0)).otherwise(
            F.try_divide(value - low, high - low)
        )
    return df.withColumn("__fit", fit.scalar()).withColumns(scaled).drop("__fit")
