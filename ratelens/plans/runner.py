"""Run many queries and save each result, with every failure kept to its own query."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.star import Star
from ratelens.plans.business import QUERIES
from ratelens.session import raise_if_stopped
from ratelens.sources.writers import write_csv, write_dataset

# The four batches of queries.
BATCHES = {
    "filters_and_windows": (
        "low_ratings_niche", "users_never_low", "top_locations_fans", "rating_vs_user_mean", "popularity_gap",
        "user_rating_count_window",
    ),
    "sources_and_studios": (
        "source_not_type", "titles_rated_one_by_group", "fan_ratings_of_type", "high_raters_by_location_studio",
        "high_rating_share_by_source", "top3_per_studio",
    ),
    "users_and_ratings": (
        "harsh_active_users", "critic_ratings_of_user", "avg_episodes_by_age_rating", "avg_deviation_by_studio",
        "rating_count_by_group", "user_quintiles", "user_quintile_stats",
    ),
    "genres_and_types": (
        "studio_high_score", "recent_users_in_location", "count_category_short", "perfect_raters_of_title",
        "avg_rating_by_genre", "rank_within_type",
    ),
}


def query_tag(name: str) -> str:
    """Tag of a query's jobs."""
    return f"ratelens-{name}"


def cancel_query(spark: SparkSession, name: str) -> None:
    """Cancel the running jobs of one query; it is reported as failed and the others go on."""
    spark.sparkContext.cancelJobsWithTag(query_tag(name))


def run_queries(
    star: Star,
    names: Iterable[str] | None = None,
    sink: Callable[[str, DataFrame], object] | None = None,
    parameters: dict[str, dict] | None = None,
    at_once: int = 1,
) -> list[tuple[str, str, str | None]]:
    """Run the named queries (all by default) into ``sink``; returns (name, status, error) per query, in their order.

    ``at_once`` queries run side by side, so that small ones fill the cores that a large one's last tasks leave
    idle. A query's jobs carry its tag and are in a scheduler pool of its name, which counts under
    ``spark.scheduler.mode=FAIR``. A failing query stops no other, but the end of the application stops all.
    """
    spark = star.fact.sparkSession
    context = spark.sparkContext

    def run(name: str) -> tuple[str, str, str | None]:
        context.addJobTag(query_tag(name))
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            result = QUERIES[name](star, **(parameters or {}).get(name, {}))
            if sink:
                sink(name, result)
            return name, "ok", None
        except Exception as error:  # the other queries still run
            raise_if_stopped(spark)
            return name, "failed", str(error)
        finally:
            context.removeJobTag(query_tag(name))
            context.setLocalProperty("spark.scheduler.pool", None)

    wanted = list(QUERIES if names is None else names)
    if at_once == 1:
        return [run(name) for name in wanted]
    with ThreadPoolExecutor(at_once) as threads:
        # Wrapped one by one: a wrapped function carries one set of local properties, which its calls would share.
        running = [threads.submit(inheritable_thread_target(spark)(run), name) for name in wanted]
        return [query.result() for query in running]


def run_batch(
    spark: SparkSession,
    star: Star,
    batch: str,
    path: str,
    single_file: bool = False,
    formats: str = "csv",
    parameters: dict[str, dict] | None = None,
    at_once: int = 1,
) -> DataFrame:
    """One batch as ``<path>/<query>.csv``, ``.parquet`` or both; returns the status of each query.

    Rows are counted from the footers of Parquet files, so a batch in CSV alone has no counts.
    """
    counts: dict[str, int] = {}

    def sink(name: str, result: DataFrame) -> None:
        if formats == "csv":
            write_csv(result, f"{path}/{name}.csv", single_file)
        else:
            write_dataset(result, f"{path}/{name}", formats)
            counts[name] = spark.read.parquet(f"{path}/{name}.parquet").count()

    outcome = run_queries(star, BATCHES[batch], sink, parameters, at_once)
    kinds = {"query": "string", "status": "string", "row_count": "bigint", "error": "string"}
    rows = [(name, status, counts.get(name), error) for name, status, error in outcome]
    told = [F.struct(*[F.lit(v).cast(k).alias(c) for v, (c, k) in zip(row, kinds.items())]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*told)))  # from a list, it would take Python workers
