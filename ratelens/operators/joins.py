"""Joins on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.session import stored

ROWS_PER_SLICE = 2_000_000

#: Most bytes of a dimension's rows that are broadcast, by a count and the widths of their columns.
BROADCAST_BYTES = 48_000_000
_TEXT, _VALUE, _ROW = 32, 8, 12  # bytes of a text, of any other value, and of a row beside its values


def by_count(small: DataFrame) -> DataFrame:
    """``small`` with a hint for its join: few rows are broadcast, more are shuffled and hashed, so that neither side is sorted."""
    row = _ROW + sum(_TEXT if kind == "string" else _VALUE for _, kind in small.dtypes)
    return small.hint("broadcast" if small.count() * row <= BROADCAST_BYTES else "shuffle_hash")


def join_selected(big: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Inner equi-join of ``big`` with those rows of a dimension (one row per key) that a filter leaves.

    How few a filter leaves is not known when a join is planned, so ``big`` was shuffled and sorted beside a handful of
    rows. ``selected`` is stored and its rows counted.
    """
    return big.join(by_count(stored(selected, "selected")), key)


def hot_keys(counts: DataFrame, key: str, count: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """All keys with more than one slice of rows, and their number of slices.

    There are fewer of them than rows divided by ``rows_per_slice``.
    """
    return counts.filter(F.col(count) > rows_per_slice).select(key, F.ceil(F.col(count) / rows_per_slice).alias("__slices"))


def sliced_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join of ``big`` with ``small`` (one row per key), spreading each hot key over its slices.

    A hot key's rows go to a slice by the hash of ``spread_by``; its one row of ``small`` is repeated
    once per slice, so the result is the plain join's. ``hot`` is broadcast, as it is a small share of the keys; left to
    adaptive execution, ``big`` was shuffled once more before it was known to be small. ``small`` is hashed, so
    that the rows of ``big`` need no sort.
    """
    hot = F.broadcast(hot)
    slices = F.coalesce(F.col("__slices"), F.lit(1))
    left = big.join(hot, key, "left").withColumn("__slice", F.pmod(F.xxhash64(*spread_by), slices)).drop("__slices")
    right = (
        small.join(hot, key, "left")
        .withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices.cast("bigint") - 1)))
        .drop("__slices")
    )
    return left.join(right.hint("shuffle_hash"), [key, "__slice"], how).drop("__slice")


def with_group_stats(
    df: DataFrame,
    key: str,
    stats: Sequence[Column],
    spread_by: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    attributes: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Each row beside aggregates of its group, as ``agg() OVER (PARTITION BY key)`` for non-NULL keys.

    A window would bring a whole group into one task. Map-side aggregation and a sliced join do not.
    ``attributes`` (one row per key) are joined to the aggregates and not to ``df``, which is shuffled
    only once. The aggregates are stored, as both the list of hot keys and the join read them. ``groups`` are stored
    aggregates, with the group's size as ``__rows``, if there are such. Without a hot key there are no slices.
    """
    if groups is None:
        groups = stored(df.groupBy(key).agg(*stats, F.count("*").alias("__rows")), "group-stats")
    small = groups.drop("__rows")
    if attributes is not None:
        small = small.join(attributes, key)
    largest = groups.agg(F.max("__rows")).first()[0]
    if (largest or 0) <= rows_per_slice:
        return df.join(small.hint("shuffle_hash"), key)
    return sliced_join(df, small, key, hot_keys(groups, key, "__rows", rows_per_slice), spread_by)
