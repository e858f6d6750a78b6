"""Star schema: user, title and date dimensions with dense keys, and the ratings fact."""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.casting import typed
from ratelens.operators.joins import by_count
from ratelens.operators.ranking import dense_row_number
from ratelens.session import side_by_side

# Raw column -> dimension column and type.
USER_COLUMNS = (
    ("Mal ID", "User_ID", "bigint"),
    ("Username", "Username", "string"),
    ("Gender", "Gender", "string"),
    ("Birthday", "Birthday", "date"),
    ("Location", "Location", "string"),
    ("Joined", "Joined_Date", "date"),
    ("Mean Score", "User_Mean_Score", "double"),
    ("Completed", "User_Total_Completed", "int"),
    ("Watching", "User_Watching", "int"),
    ("On Hold", "User_On_Hold", "int"),
    ("Dropped", "User_Dropped", "int"),
    ("Plan to Watch", "User_Plan_to_Watch", "int"),
    ("Total Entries", "User_Total_Entries", "int"),
    ("Days Watched", "User_Days_Watched", "double"),
    ("Episodes Watched", "User_Episodes_Watched", "int"),
)
TITLE_COLUMNS = (
    ("anime_id", "Anime_ID", "bigint"),
    ("Name", "Name", "string"),
    ("English name", "English_Name", "string"),
    ("Type", "Type", "string"),
    ("Source", "Source", "string"),
    ("Genres", "Genres", "string"),
    ("Studios", "Studios", "string"),
    ("Producers", "Producers", "string"),
    ("Score", "Avg_Score", "double"),
    ("Popularity", "Popularity_Rank", "int"),
    ("Episodes", "Episodes", "double"),
    ("Rating", "Age_Rating", "string"),
    ("Rank", "Rank", "double"),
    ("Members", "Members", "double"),
    ("Favorites", "Favorites", "double"),
    ("Scored By", "Scored_By", "double"),
    ("Aired", "Aired", "string"),
    ("Premiered", "Premiered", "string"),
    ("Status", "Status", "string"),
    ("Duration", "Duration", "string"),
)


def _schema(key: str, mapping) -> str:
    return ", ".join([f"{key} bigint", *[f"{name} {kind}" for _, name, kind in mapping]])


STAR_SCHEMAS = {
    "dim_user": _schema("User_SK", USER_COLUMNS),
    "dim_anime": _schema("Anime_SK", TITLE_COLUMNS),
    "dim_date": "Date_SK int, Full_Date date, Year int, Quarter int, Month int, Month_Name string, "
    "Day_of_Week string, Is_Weekend boolean",
    "fact_user_ratings": "User_SK bigint, Anime_SK bigint, Date_SK int, User_Rating int, Rating_Deviation double, "
    "Is_Above_Average int, Is_High_Rating int, Is_Low_Rating int, Rating_Count int",
}


class Star(NamedTuple):
    dim_user: DataFrame
    dim_anime: DataFrame
    dim_date: DataFrame | None
    fact: DataFrame
    user_totals: DataFrame | None = None  # sums of the fact per user and per title, if stored for several queries
    title_totals: DataFrame | None = None


def _typed_columns(raw: DataFrame, mapping) -> DataFrame:
    kinds = dict(raw.dtypes)
    return raw.select(
        *[
            (F.col(f"`{source}`") if kinds.get(source) == kind else typed(F.col(f"`{source}`"), kind)).alias(name)
            for source, name, kind in mapping
        ]
    )


def _with_key(dimension: DataFrame, key: str, natural_id: str) -> DataFrame:
    numbered = dense_row_number(dimension, [F.col(natural_id).asc_nulls_first()], output=key)
    return numbered.select(key, *dimension.columns)


def user_dimension(users: DataFrame) -> DataFrame:
    """Typed user attributes with ``User_SK`` 1..n in id order."""
    return _with_key(_typed_columns(users, USER_COLUMNS), "User_SK", "User_ID")


def title_dimension(titles: DataFrame) -> DataFrame:
    """Typed title attributes with ``Anime_SK`` 1..n in id order."""
    return _with_key(_typed_columns(titles, TITLE_COLUMNS), "Anime_SK", "Anime_ID")


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("Full_Date")
    return days.select(
        date_key(day).alias("Date_SK"),
        day,
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("Month_Name"),
        F.date_format(day, "EEEE").alias("Day_of_Week"),
        F.dayofweek(day).isin(1, 7).alias("Is_Weekend"),
    )


def date_key(day):
    """``yyyymmdd`` as an int."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


#: Fixed value: first and last day of the default calendar.
CALENDAR = ("2000-01-01", "2025-12-31")


def date_dimension(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return _calendar(bounds.select(F.explode(F.sequence("start", "end")).alias("Full_Date")))


def date_dimension_of(fact: DataFrame) -> DataFrame:
    """One row per day of the span that the fact's date keys cover."""
    span = fact.agg(F.min("Date_SK").alias("low"), F.max("Date_SK").alias("high")).filter(F.col("low").isNotNull())
    start, end = (F.to_date(F.col(c).cast("string"), "yyyyMMdd") for c in ("low", "high"))
    return _calendar(span.select(F.explode(F.sequence(start, end)).alias("Full_Date")))


def ratings_fact(
    ratings: DataFrame,
    dim_user: DataFrame,
    dim_anime: DataFrame,
    dim_date: DataFrame | None = None,
    date_column: str | None = None,
    load_date: str | None = None,
) -> DataFrame:
    """Ratings of known users and titles with keys, deviation and flags.

    The date key belongs to ``date_column`` when the source has one, else to the load date; with a
    ``dim_date`` it is looked up there, and days outside that calendar get no key. Titles' ids and keys are counted:
    few are broadcast, more are shuffled and hashed, and adaptive execution splits hot titles. Users come last and always
    by a shuffle, a task's ids and keys being hashed, so that a user's ratings end up in one task without another shuffle;
    adaptive execution splits hot users.
    """
    if date_column:
        day = F.col(date_column).cast("date")
    else:
        day = F.lit(load_date).cast("date") if load_date else F.current_date()
    rows = ratings.select(
        F.col("user_id").alias("User_ID"),
        F.col("anime_id").alias("Anime_ID"),
        typed(F.col("rating"), "int").alias("User_Rating"),
        date_key(day).alias("Date_SK"),
    ).join(by_count(dim_anime.select("Anime_SK", "Anime_ID", "Avg_Score")), "Anime_ID")
    if dim_date is not None:
        known = dim_date.select(F.col("Date_SK").alias("__day"))
        rows = rows.join(known, F.col("Date_SK") == F.col("__day"), "left").withColumn("Date_SK", F.col("__day"))
    rows = rows.join(dim_user.select("User_SK", "User_ID").hint("shuffle_hash"), "User_ID")
    rating = F.col("User_Rating")
    return rows.select(
        "User_SK",
        "Anime_SK",
        "Date_SK",
        rating,
        (rating - F.col("Avg_Score")).alias("Rating_Deviation"),
        F.when(rating > F.col("Avg_Score"), 1).otherwise(0).alias("Is_Above_Average"),
        F.when(rating >= 8, 1).otherwise(0).alias("Is_High_Rating"),
        F.when(rating <= 4, 1).otherwise(0).alias("Is_Low_Rating"),
        F.lit(1).alias("Rating_Count"),
    )


def build_star(
    users: DataFrame,
    titles: DataFrame,
    ratings: DataFrame,
    date_column: str | None = None,
    load_date: str | None = None,
) -> Star:
    """All four tables from raw inputs.

    Dated ratings leave ``dim_date`` open: it covers their span and is derived from the stored fact,
    which is far cheaper to read than the ratings are to compute again. Otherwise it is the default range,
    extended to the load date, which is today unless given.
    """
    dim_user, dim_anime = side_by_side(
        ratings.sparkSession, lambda: user_dimension(users), lambda: title_dimension(titles)
    )
    if date_column:
        return Star(dim_user, dim_anime, None, ratings_fact(ratings, dim_user, dim_anime, None, date_column))
    day = load_date or datetime.date.today().isoformat()
    dim_date = date_dimension(ratings.sparkSession, min(CALENDAR[0], day), max(CALENDAR[1], day))
    return Star(dim_user, dim_anime, dim_date, ratings_fact(ratings, dim_user, dim_anime, dim_date, None, day))
