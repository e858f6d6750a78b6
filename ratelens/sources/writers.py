"""Sinks: star schema, query results, datasets with metadata, and reuse of finished outputs."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.profiling import assess_numeric, describe_dataset, numeric_columns, numeric_statistics
from ratelens.operators.star import Star, date_dimension_of
from ratelens.session import side_by_side
from ratelens.sources.readers import load_star, path_exists


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV directory with header; ``single_file`` writes by one task and is meant for small results."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_dataset(df: DataFrame, path: str, formats: str = "both") -> None:
    """``<path>.csv``, ``<path>.parquet`` or both."""
    if formats not in ("csv", "parquet", "both"):
        raise ValueError(f"unknown format {formats}")
    if formats != "csv":
        df.write.mode("overwrite").parquet(f"{path}.parquet")
        df = df.sparkSession.read.parquet(f"{path}.parquet")  # the CSV copies the result instead of recomputing it
    if formats != "parquet":
        write_csv(df, f"{path}.csv")


def write_metadata(spark: SparkSession, metadata: dict, path: str) -> None:
    """One JSON document written by Spark, so that any shared file system works."""
    text = spark.range(1, numPartitions=1).select(F.lit(json.dumps(metadata, ensure_ascii=False)).alias("value"))
    text.write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


FACT_ROWS_PER_FILE = 2_000_000


def save_star(star: Star, path: str) -> None:
    """The star as Parquet, the fact clustered by user, and a calendar of its days if the star has none.

    ``ratings_fact`` ends with a user's ratings in one task; a file has ``FACT_ROWS_PER_FILE`` rows at most, so that
    large users are split. Aggregation per user then mostly completes before its shuffle, and row groups
    sorted by user are skipped by queries for one user.
    """
    spark = star.fact.sparkSession
    sorted_fact = star.fact.sortWithinPartitions("User_SK")  # one whole number, so sorted by radix
    tables = {"dim_user": star.dim_user, "dim_anime": star.dim_anime, "fact_user_ratings": sorted_fact}

    def save(name: str) -> None:
        writer = tables[name].write.mode("overwrite").option("maxRecordsPerFile", FACT_ROWS_PER_FILE)
        writer.parquet(f"{path}/{name}")

    side_by_side(spark, *[functools.partial(save, name) for name in tables])
    dim_date = star.dim_date
    if dim_date is None:
        dim_date = date_dimension_of(spark.read.parquet(f"{path}/fact_user_ratings"))
    dim_date.write.mode("overwrite").parquet(f"{path}/dim_date")


def ensure_star(spark: SparkSession, path: str, build: Callable[[], Star], parameters: dict | None = None) -> Star:
    """The star stored at ``path``, built and written first unless one of the same ``parameters`` is there.

    The caller always gets the stored tables, never the lineage that produced them.
    """
    done, parameters = f"{path}/finished", json.loads(json.dumps(parameters or {}))
    if not finished(spark, done, parameters):
        save_star(build(), path)
        write_metadata(spark, {"tables": 4, "parameters": parameters}, done)
    return load_star(spark, path)


def finished(spark: SparkSession, done: str, parameters: dict) -> bool:
    """Whether the marker is of these parameters; ``inputs`` that are gone (None) count as those it was built from."""
    if not path_exists(spark, done):
        return False
    known, wanted = read_metadata(spark, done).get("parameters"), json.loads(json.dumps(parameters))
    if known and "inputs" in wanted and wanted["inputs"] is None:
        wanted["inputs"] = known.get("inputs")
    return known == wanted


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], parameters: dict | None = None
) -> DataFrame:
    """The table stored at ``path``, built and written first unless one of the same ``parameters`` is there.

    Parameters are values of JSON and should name all that the table depends on, its inputs too.
    """
    done, parameters = f"{path}.finished", json.loads(json.dumps(parameters or {}))
    if not finished(spark, done, parameters):
        frame = build()
        frame.write.mode("overwrite").parquet(path)
        write_metadata(spark, {"columns": frame.columns, "parameters": parameters}, done)
    return spark.read.parquet(path)


def write_dataset_info(df: DataFrame, path: str) -> DataFrame:
    """Column profile of ``df`` as JSON rows; returns the profile."""
    profile = describe_dataset(df)
    profile.coalesce(1).write.mode("overwrite").json(f"{path}/dataset_info.json")
    return profile


def write_numeric_statistics(df: DataFrame, path: str) -> DataFrame:
    """Numeric statistics as CSV and JSON and their assessment as JSON; returns the statistics.

    One row per numeric column, so the stored rows are read back instead of scanning ``df`` again.
    """
    statistics = numeric_statistics(df)
    statistics.coalesce(1).write.mode("overwrite").json(f"{path}/numeric_statistics.json")
    if not numeric_columns(df):
        return statistics
    stored = df.sparkSession.read.schema(statistics.schema).json(f"{path}/numeric_statistics.json")
    write_csv(stored, f"{path}/numeric_statistics.csv", single_file=True)
    assess_numeric(stored).coalesce(1).write.mode("overwrite").json(f"{path}/numeric_assessment.json")
    return stored
