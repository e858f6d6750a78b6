"""Reproducible samples and train/validation/test splits keyed by a row's id.

All of them depend on the seed and the id alone, so that repartitioning or a recomputed task never
moves a row from one split to another.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.hashing import HASH_SPAN, seeded_hash
from ratelens.operators.ranking import dense_row_number
from ratelens.session import stored


def _hashed(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, list[Column]]:
    """``df`` with its hash as a column, since a sort evaluates expressions again for every comparison."""
    hashed = df.withColumn("__hash", seeded_hash(F.col(f"`{key}`"), seed))
    return hashed, [F.col("__hash").asc(), F.col(f"`{key}`").asc()]


def _lowest_hashes(hashed: DataFrame, n: int) -> DataFrame:
    """A little more than the ``n`` rows of lowest hash, by a filter whose cut follows from the row count.

    Should the cut hold fewer than ``n`` rows, which six deviations make all but impossible, all rows
    are returned, so that the sample stays exact.
    """
    total = hashed.count()
    wanted = n + 6 * math.sqrt(n) + 10
    if wanted >= total:
        return hashed
    lowest = stored(hashed.filter(F.col("__hash") < int(HASH_SPAN * wanted / total)), "sample")
    return lowest if lowest.count() >= n else hashed


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by hash order of the unique ``key``; only about ``n`` rows are sorted."""
    hashed, order = _hashed(df, key, seed)
    lowest = _lowest_hashes(hashed, n)
    return dense_row_number(lowest, order, output="__rn").filter(F.col("__rn") <= n).drop("__rn", "__hash")


def random_split(
    df: DataFrame, key: str, train: float = 0.70, validation: float = 0.15, seed: int = 42
) -> DataFrame:
    """Adds ``split`` by comparing the id's hash with the cumulative shares; no shuffle."""
    share = seeded_hash(F.col(f"`{key}`"), seed) / F.lit(float(HASH_SPAN))
    return df.withColumn("split", _label(share, train, train + validation, strict=True))


def stratified_split(
    df: DataFrame, key: str, label: str, train: float = 0.70, validation: float = 0.15, seed: int = 42
) -> DataFrame:
    """Adds ``split`` with exact shares inside every class: cut at int(n * share) in hash order."""
    hashed, order = _hashed(df, key, seed)
    numbered = dense_row_number(hashed, order, [label], output="__rn", group_size="__n")
    first = F.floor(F.col("__n") * train)
    second = F.floor(F.col("__n") * (train + validation))
    return numbered.withColumn("split", _label(F.col("__rn"), first, second, strict=False)).drop(
        "__rn", "__n", "__hash"
    )


def _label(value: Column, first, second, strict: bool) -> Column:
    in_train = value < first if strict else value <= first
    in_validation = value < second if strict else value <= second
    return F.when(in_train, "train").when(in_validation, "validation").otherwise("test")


def split_report(split: DataFrame) -> DataFrame:
    """Rows and share of every split."""
    sizes = split.groupBy("split").agg(F.count("*").alias("row_count"))
    total = sizes.agg(F.sum("row_count")).scalar()
    return sizes.withColumn("share", F.col("row_count") / total)


def class_balance(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Rows per class, optionally within each split."""
    return df.groupBy(*by, label).agg(F.count("*").alias("row_count"))
