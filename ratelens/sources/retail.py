"""Raw rating inputs derived from the retail tables.

Customers act as users, parts as titles and order lines as ratings. The views have the columns of the
raw CSV inputs, including ISO date text, ``UNKNOWN`` scores and missing values, and so run through the
same typing and key operators as real inputs. Views and star are stored once per application in the
shared folder.
"""

from __future__ import annotations

import functools
import hashlib
import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.vocabulary import AGE_RATINGS, GENRES, SOURCES, STUDIOS, TYPES
from ratelens.operators.star import Star, build_star
from ratelens.session import scratch_root, side_by_side
from ratelens.sources.readers import path_exists
from ratelens.sources.writers import ensure_star, materialize

_locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)  # by path; views are built side by side
_View = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    """``values[index]``, NULL beyond the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _users_view(spark: SparkSession, directory: str) -> DataFrame:
    customer, nation = table(spark, directory, "customer"), table(spark, directory, "nation")
    first_order = table(spark, directory, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    users = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        first_order, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    key = F.col("c_custkey")
    completed = F.floor(F.abs("c_acctbal")).cast("int")
    whole = lambda modulus: F.pmod(key, F.lit(modulus)).cast("int")
    iso = lambda day: F.concat(day.cast("string"), F.lit("T00:00:00+00:00"))
    return users.select(
        key.alias("Mal ID"),
        F.col("c_name").alias("Username"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "Female")
        .when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), "Male")
        .alias("Gender"),
        F.when(whole(10) != 9, iso(F.date_add(F.lit("1970-01-01").cast("date"), whole(9000)))).alias("Birthday"),
        F.when(F.col("n_name") == "NATION_3", "Canada")
        .when(F.col("n_name") == "NATION_4", "USA")
        .when(F.col("n_name") != "NATION_7", F.col("n_name"))
        .alias("Location"),
        iso(F.col("first_order").cast("date")).alias("Joined"),
        (completed / F.lit(60.0)).alias("Days Watched"),
        F.when(whole(50) != 0, F.col("c_acctbal") / 1000.0).alias("Mean Score"),
        whole(20).alias("Watching"),
        completed.alias("Completed"),
        whole(7).alias("On Hold"),
        whole(11).alias("Dropped"),
        whole(50).alias("Plan to Watch"),
        F.when(whole(97) == 0, 0).otherwise(completed + whole(20) + whole(11)).alias("Total Entries"),
        whole(5).alias("Rewatched"),
        (completed * 12).alias("Episodes Watched"),
    )


#: A table of titles takes few bytes and much work a row, so it is dealt out by rows: a task by bytes would have millions.
TITLES_PER_FILE = 50_000


def _titles_view(spark: SparkSession, directory: str) -> DataFrame:
    """One row per part with the columns of both title inputs."""
    parts = table(spark, directory, "part")
    parts = parts.repartition(parts.count() // TITLES_PER_FILE + 1, "p_partkey")
    key, size = F.col("p_partkey"), F.col("p_size")
    whole = lambda modulus: F.pmod(key, F.lit(modulus)).cast("int")
    brand = F.substring("p_brand", 7, 10).cast("int")
    types = F.create_map(*[F.lit(v) for pair in zip(_PART_TYPES, TYPES) for v in pair])
    number = size.cast("string")
    return parts.select(
        key.alias("anime_id"),
        F.col("p_name").alias("Name"),
        F.upper("p_name").alias("English name"),
        F.when(whole(10) != 3, types[F.col("p_type")]).alias("Type"),
        _pick(SOURCES, whole(10)).alias("Source"),
        F.concat_ws(", ", _pick(GENRES, whole(30)), _pick(GENRES, size % 29), _pick(GENRES, size % 7)).alias("Genres"),
        F.when(brand % 5 == 0, F.concat_ws(", ", _pick(STUDIOS, brand % 20), _pick(STUDIOS, (brand + 3) % 20)))
        .when(brand % 11 != 1, _pick(STUDIOS, brand % 20))
        .alias("Studios"),
        F.col("p_brand").alias("Producers"),
        F.when(whole(17) == 0, "UNKNOWN")
        .otherwise(F.round((F.col("p_retailprice") - 900.0) / 10.0, 2).cast("string"))
        .alias("Score"),
        F.when(whole(23) != 0, whole(997) + 1).alias("Popularity"),
        F.when(whole(13) == 0, "Unknown").otherwise(number).alias("Episodes"),
        _pick((*AGE_RATINGS, "24 min per ep", "UNKNOWN"), whole(8)).alias("Rating"),
        (key + 1).cast("int").alias("Rank"),
        (size * 100).alias("Members"),
        (size * 7).alias("Favorites"),
        (whole(500) * 3).alias("Scored By"),
        F.when(
            whole(9) != 0,
            F.concat(
                F.lit("Apr 3, "), (whole(30) + 1980).cast("string"),
                F.lit(" to Jun 24, "), (whole(30) + 1981).cast("string"),
            ),
        ).otherwise("Not available").alias("Aired"),
        F.concat(F.lit("spring "), (whole(30) + 1980).cast("string")).alias("Premiered"),
        F.lit("Finished Airing").alias("Status"),
        F.when(whole(5) == 0, F.concat(F.lit("1 hr "), number, F.lit(" min per ep")))
        .when(whole(5) == 1, F.concat(number, F.lit(" min per ep")))
        .when(whole(5) == 2, F.lit("2 hr per ep"))
        .when(whole(5) == 3, F.concat(number, F.lit(" sec per ep")))
        .otherwise("Unknown")
        .alias("Duration"),
        F.when(whole(19) != 0, size * 11).alias("Watching"),
        F.when(whole(29) != 0, whole(700)).alias("Completed"),
        whole(13).alias("On-Hold"),
        whole(7).alias("Dropped"),
        key.alias("Ranked"),
    )


# Part types in the order of the title types they stand for.
_PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _ratings_view(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, directory, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("rated_on")
    )
    # Orders are hashed: the lines, four times as many, need no sort.
    return lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("anime_id"),
        (((F.col("l_quantity") - 1) % 10) + 1).cast("int").alias("rating"),
        "rated_on",
    )


def stored_path(spark: SparkSession, directory: str, name: str) -> str:
    """Where this application keeps what it derived from the tables of a directory."""
    digest = hashlib.md5(directory.encode()).hexdigest()
    return f"{scratch_root(spark)}/retail-{digest}/{name}"


def _stored_view(spark: SparkSession, directory: str, name: str, view: _View) -> DataFrame:
    """A view stored on first use: the raw inputs are tables, not lineage to repeat in every query."""
    path = stored_path(spark, directory, name)
    with _locks[path]:
        return materialize(spark, path, lambda: view(spark, directory))


def raw_users(spark: SparkSession, directory: str) -> DataFrame:
    return _stored_view(spark, directory, "users", _users_view)


def raw_titles(spark: SparkSession, directory: str) -> DataFrame:
    return _stored_view(spark, directory, "titles", _titles_view)


def raw_ratings(spark: SparkSession, directory: str) -> DataFrame:
    return _stored_view(spark, directory, "ratings", _ratings_view)


def retail_star(spark: SparkSession, directory: str) -> Star:
    """The star over the retail tables, stored on first use.

    Its fact holds all that the ratings view has, so that is not stored for the fact alone, only read if it is there.
    """

    def build() -> Star:
        views = [functools.partial(view, spark, directory) for view in (raw_users, raw_titles)]
        known = path_exists(spark, f"{stored_path(spark, directory, 'ratings')}.finished")
        ratings = (raw_ratings if known else _ratings_view)(spark, directory)
        return build_star(*side_by_side(spark, *views), ratings, "rated_on")

    path = stored_path(spark, directory, "star")
    with _locks[path]:
        return ensure_star(spark, path, build)
