"""Relations between features and a target, each in one pass for all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators.quantiles import quantile_values
from ratelens.session import stored


def feature_target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every feature with the target (NULL for a constant feature).

    Features are unpivoted, so that one small aggregation serves any number of them; each task keeps
    one partial row per feature.
    """
    goal = F.col("__target")
    value = F.col("value")
    return (
        df.withColumn("__target", F.col(f"`{target}`").cast("double"))
        .filter(goal.isNotNull())
        .unpivot("__target", [F.col(f"`{c}`") for c in features], "feature", "value")
        .groupBy("feature")
        .agg(
            F.try_divide(F.covar_pop(value, goal), F.stddev_pop(value) * F.stddev_pop(goal)).alias("correlation")
        )
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count, mean, exact median, deviation, minimum, maximum, range and skewness of the target."""
    value = F.col(f"`{target}`")
    median = quantile_values(stored(df.select(value), "target"), [target], [0.5])[target, 0.5]
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.lit(median).cast(df.schema[target].dataType).alias("median"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.max(value) - F.min(value)).alias("value_range"),
        F.skewness(value).alias("skewness"),
    )


def class_feature_means(df: DataFrame, features: Sequence[str], label: str, first, second) -> DataFrame:
    """Mean of every feature in two classes and the ratio second / first, in one pass; NULL without rows."""
    group = F.col(f"`{label}`")
    means = df.agg(
        *[
            F.avg(F.when(group == wanted, F.col(f"`{name}`"))).alias(f"{side}{i}")
            for i, name in enumerate(features)
            for side, wanted in (("first", first), ("second", second))
        ]
    )
    rows = [
        F.struct(F.lit(name).alias("feature"), F.col(f"first{i}").alias("mean_first"), F.col(f"second{i}").alias("mean_second"))
        for i, name in enumerate(features)
    ]
    ratio = F.try_divide(F.col("mean_second"), F.col("mean_first"))
    return means.select(F.inline(F.array(*rows))).withColumn("ratio", ratio)


def collapse_titles(ratings: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Denormalised ratings to one row per title with its attributes and number of ratings.

    Attributes must be the same on all rows of a title; ``min`` makes the choice definite if not.
    """
    return ratings.groupBy(key).agg(
        *[F.min(c).alias(c) for c in attributes], F.count("*").alias("user_ratings_count")
    )
