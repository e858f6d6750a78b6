"""Table profiles: one aggregation for all columns, one result row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _rows_per_column(totals: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*structs)))


def dataset_info(df: DataFrame) -> DataFrame:
    """Position, name, type, nullability and NULL count of every column, with the row count."""
    fields = df.schema.fields
    totals = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(_quoted(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)],
    )
    return _rows_per_column(
        totals,
        [
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col("rows").alias("row_count"),
                F.lit(len(fields)).alias("column_count"),
                F.col(f"n{i}").alias("null_count"),
            )
            for i, f in enumerate(fields)
        ],
    )


def describe_dataset(df: DataFrame) -> DataFrame:
    """``dataset_info`` with NULL percentages (0 for an empty table)."""
    share = F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("row_count")), F.lit(0.0))
    return dataset_info(df).withColumn("null_percentage", share)


def sample_rows(df: DataFrame, order_by: Sequence[Column], n: int = 3) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


_STATS_SCHEMA = (
    "column_name string, count bigint, mean double, stddev double, min double, max double, "
    "null_count bigint, null_percentage double"
)


def numeric_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, maximum and NULLs of every numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], _STATS_SCHEMA)
    aggregates = [F.count("*").alias("rows")]
    for i, name in enumerate(names):
        value = _quoted(name)
        aggregates += [
            F.count(value).alias(f"c{i}"),
            F.avg(value).cast("double").alias(f"a{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
            F.min(value).cast("double").alias(f"l{i}"),
            F.max(value).cast("double").alias(f"h{i}"),
        ]
    return _rows_per_column(
        df.agg(*aggregates),
        [
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"c{i}").alias("count"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("stddev"),
                F.col(f"l{i}").alias("min"),
                F.col(f"h{i}").alias("max"),
                (F.col("rows") - F.col(f"c{i}")).alias("null_count"),
                F.coalesce(
                    F.try_divide((F.col("rows") - F.col(f"c{i}")) * 100.0, F.col("rows")), F.lit(0.0)
                ).alias("null_percentage"),
            )
            for i, name in enumerate(names)
        ],
    )


def assess_numeric(statistics: DataFrame) -> DataFrame:
    """Quality by NULL share, spread by coefficient of variation, and the range, per column."""
    nulls = F.col("null_percentage")
    quality = (
        F.when(nulls == 0, "excellent").when(nulls < 5, "good").when(nulls < 20, "acceptable").otherwise("poor")
    )
    variation = F.when(F.col("stddev") > 0, F.try_divide(F.col("stddev"), F.col("mean")) * 100)
    cv = F.col("coefficient_of_variation")
    spread = F.when(cv < 15, "low").when(cv < 35, "moderate").when(cv.isNotNull(), "high")
    return (
        statistics.withColumn("coefficient_of_variation", variation)
        .withColumn("quality", quality)
        .withColumn("spread", spread)
        .withColumn("value_range", F.col("max") - F.col("min"))
        .select(
            "column_name", "null_percentage", "quality", "coefficient_of_variation", "spread",
            "min", "max", "value_range",
        )
    )


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits of a row's values, as two longs; a hash skips NULLs, so where they are is hashed too."""
    columns = [_quoted(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(nulls, *columns).alias("__one"), F.xxhash64(F.lit("row"), *columns[::-1], nulls).alias("__two")]


def quality_report(df: DataFrame) -> DataFrame:
    """One row: rows, repeated rows, NULL cells and their share. Rows are compared, and shuffled, by their digests."""
    cells = sum((F.when(_quoted(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    # Identical rows are counted map-side before the shuffle, also when one row makes up much of the table.
    rows = df.select(*row_digest(df), cells.alias("__cells"))
    distinct = rows.groupBy("__one", "__two").agg(F.count("*").alias("__copies"), F.sum("__cells").alias("__cells"))
    totals = distinct.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("__cells"), F.lit(0)).alias("null_cells"),
    )
    share = F.coalesce(
        F.try_divide(F.col("null_cells") * 100.0, F.col("row_count") * len(df.columns)), F.lit(0.0)
    )
    return totals.withColumn("null_percentage", share)
