"""Row numbers, buckets and neighbours over a total order, without a one-task window.

``row_number()`` without a PARTITION BY, or with one huge group, sorts all of its rows in one task.
Here the rows are sorted once by range partitioning, so that a hot group spans several tasks, and
stored with their position. A per-task summary, one row per task and group, then turns positions into
ranks. The stored table fixes the positions: a lost executor recomputes from files, not from a sort
whose range bounds might differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.session import stored

_POS = "__pos"
_TASK = "__task"
_TASK_SHIFT = 33  # monotonically_increasing_id keeps the partition number above 33 row bits


def _store_sorted(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Range-sort, attach the position and write; reading back allows pruned passes over it."""
    keys = [F.col(name).asc_nulls_first() for name in partition_by] + list(order_by)
    positioned = stored(df.orderBy(*keys).withColumn(_POS, F.monotonically_increasing_id()), "sorted")
    return positioned.withColumn(_TASK, F.shiftright(F.col(_POS), _TASK_SHIFT))


def dense_row_number(
    df: DataFrame,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    output: str = "row_number",
    group_size: str | None = None,
) -> DataFrame:
    """1..n within each group in the given order, and optionally the group's size.

    ``order_by`` must be a total order within a group, otherwise ties fall arbitrarily. It should name
    columns: the sort would evaluate an expression again for every comparison.
    """
    rows = _store_sorted(df, partition_by, order_by)
    runs = rows.groupBy(_TASK, *partition_by).agg(F.count("*").alias("__rows"), F.min(_POS).alias("__first"))
    # At most one row per sort task and group here.
    earlier = Window.partitionBy(*partition_by).orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col(_TASK).alias("__run_task"),
        *[F.col(name).alias(f"__run_{name}") for name in partition_by],
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(Window.partitionBy(*partition_by)).alias("__size"),
    )
    if not partition_by:
        runs = F.broadcast(runs)  # bounded by the number of sort tasks
    same_run = F.col(_TASK) == F.col("__run_task")
    for name in partition_by:
        same_run = same_run & F.col(name).eqNullSafe(F.col(f"__run_{name}"))
    extra = [F.col("__size").alias(group_size)] if group_size else []
    return rows.join(runs, same_run).select(
        *[F.col(f"`{name}`") for name in df.columns],
        (F.col(_POS) + F.col("__shift") + 1).alias(output),
        *extra,
    )


def ntile(df: DataFrame, buckets: int, order_by: Sequence[Column], output: str = "ntile") -> DataFrame:
    """Bucket numbers equal to SQL ``NTILE(buckets) OVER (ORDER BY ...)``."""
    numbered = dense_row_number(df, order_by, output="__rn", group_size="__n")
    index = F.col("__rn") - 1
    quotient = F.floor(F.col("__n") / buckets)
    longer = F.col("__n") % buckets  # that many buckets hold one row more
    border = longer * (quotient + 1)
    bucket = F.when(index < border, F.floor(index / (quotient + 1))).otherwise(
        longer + F.floor(F.try_divide(index - border, quotient))
    )
    return numbered.withColumn(output, (bucket + 1).cast("int")).drop("__rn", "__n")


def next_value(df: DataFrame, column: str, order_by: Sequence[Column], output: str) -> DataFrame:
    """SQL ``LEAD(column) OVER (ORDER BY ...)``: local neighbour, and across tasks the next task's first."""
    rows = _store_sorted(df, (), order_by)
    heads = rows.groupBy(_TASK).agg(F.min_by(column, _POS).alias("__head"), F.max(_POS).alias("__last"))
    # One row per sort task, hence the window and the broadcast stay small.
    heads = heads.select(
        _TASK, "__last", F.lead("__head").over(Window.orderBy(_TASK)).alias("__next_head")
    )
    local = F.lead(column).over(Window.partitionBy(_TASK).orderBy(_POS))
    joined = rows.withColumn("__local", local).join(F.broadcast(heads), _TASK)
    following = F.when(F.col(_POS) == F.col("__last"), F.col("__next_head")).otherwise(F.col("__local"))
    return joined.select(*[F.col(f"`{name}`") for name in df.columns], following.alias(output))


def top_per_group(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], k: int, output: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group; every task keeps only k rows per group before the shuffle."""
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(output, F.row_number().over(window)).filter(F.col(output) <= k)
