"""Per-user behaviour features from ratings and title attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import feature_name
from ratelens.functions.vocabulary import FULL_VOCABULARY, BehaviourVocabulary
from ratelens.operators.encoding import category_indicators, list_indicators
from ratelens.operators.scaling import fit_columns, scale

# Raw user column -> feature.
PROFILE_COLUMNS = (
    ("Days Watched", "days_watched"),
    ("Mean Score", "user_mean_score"),
    ("Completed", "user_completed"),
    ("Dropped", "user_dropped"),
    ("Plan to Watch", "user_plan_to_watch"),
    ("Total Entries", "user_total_entries"),
    ("Rewatched", "user_rewatched"),
    ("Episodes Watched", "user_episodes_watched"),
)
ROWS_PER_TASK = 250_000
PARTS_OF_USER = 4
SCALED_COLUMNS = (
    "total_ratings", "avg_rating", "days_watched", "user_mean_score", "user_completed", "user_episodes_watched",
)


def ratings_of(ratings: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Ratings whose user is among ``users`` (a frame with the same key)."""
    return ratings.join(users.select(key), key, "left_semi")


def ratings_with_titles(ratings: DataFrame, titles: DataFrame, key: str = "anime_id") -> DataFrame:
    """Every rating with its title's attributes, NULL where the title is unknown."""
    return ratings.join(titles, key, "left")


def user_behaviour(
    ratings: DataFrame, titles: DataFrame, vocabulary: BehaviourVocabulary = FULL_VOCABULARY
) -> DataFrame:
    """Rating statistics, genre and type counts and per-type averages of every user.

    The ratings are dealt to tasks of about ``ROWS_PER_TASK`` rows by user and title and summed per pair, so that a user
    with a large share of all rows is spread over its titles. Titles then meet those sums, which are dealt by user and
    part of the titles, so that a task combines most rows of its users before the shuffle and none has all rows of a
    large one. Dealt by title instead, most users would be alone in a task, whose memory grew with its rows. Titles
    are merged, as Spark judges them by their compressed size and would send them to all executors. Genre tests run
    once per title, not once per rating.
    """
    genres = list_indicators(F.col("Genres"), vocabulary.genres, "genre_count", ignore_case=vocabulary.ignore_case)
    types = category_indicators(F.col("Type"), vocabulary.types, "type_count")
    genre_names = [feature_name("genre_count", g) for g in vocabulary.genres]
    type_names = [feature_name("type_count", t) for t in vocabulary.types]
    encoded = titles.select("anime_id", *genres, *types)
    score = F.col("rating").cast("double")
    tasks = ratings.count() // ROWS_PER_TASK + 2  # a single one would need no second shuffle, and so combine nothing
    sums = ratings.repartition(tasks, F.xxhash64("user_id", "anime_id")).groupBy("user_id", "anime_id").agg(
        F.count("*").alias("__rows"),
        F.count("rating").alias("__rated"),
        F.sum(score).alias("__sum"),
        F.sum(score * score).alias("__squares"),
        F.min("rating").alias("__min"),
        F.max("rating").alias("__max"),
    )
    rated, total, squares = (F.sum(c) for c in ("__rated", "__sum", "__squares"))
    variance = F.try_divide(squares - F.try_divide(total * total, rated), rated - 1)
    part = F.pmod(F.xxhash64("anime_id"), F.lit(PARTS_OF_USER))
    stats = ratings_with_titles(sums, encoded.hint("merge")).repartition(tasks, F.xxhash64("user_id", part))
    stats = stats.groupBy("user_id").agg(
        F.sum("__rows").alias("total_ratings"),
        F.try_divide(total, rated).alias("avg_rating"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("__sd"),
        rated.alias("__count"),
        F.min("__min").alias("min_rating"),
        F.max("__max").alias("max_rating"),
        *[F.coalesce(F.sum(F.col(name) * F.col("__rows")), F.lit(0)).alias(name) for name in genre_names + type_names],
        *[
            F.try_divide(F.sum(F.when(F.col(name) == 1, F.col("__sum"))), F.sum(F.when(F.col(name) == 1, F.col("__rated"))))
            .alias(feature_name("avg_rating", t))
            for name, t in zip(type_names, vocabulary.types)
        ],
        F.count("anime_id").alias("unique_anime_count"),
    )
    spread = F.when(F.col("__count") > 1, F.col("__sd"))
    named = stats.withColumn("rating_std", spread).drop("__sd", "__count")
    first = ["user_id", "total_ratings", "avg_rating", "rating_std"]
    return named.select(*first, *[F.col(f"`{c}`") for c in named.columns if c not in first])


def user_profile(users: DataFrame) -> DataFrame:
    """The profile columns used as features; those the source lacks are 0."""
    return users.select(
        "user_id",
        "Gender",
        *[
            (F.col(f"`{raw}`").cast("double") if raw in users.columns else F.lit(0.0)).alias(name)
            for raw, name in PROFILE_COLUMNS
        ],
    )


def derived_features(features: DataFrame, vocabulary: BehaviourVocabulary = FULL_VOCABULARY) -> DataFrame:
    """Diversity, consistency, intensity, drop rate, label and genre shares, by one projection."""
    counts = [feature_name("genre_count", g) for g in vocabulary.genres]
    shares = [feature_name("genre_pct", g) for g in vocabulary.genres]
    diversity = sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in counts), F.lit(0))
    zero = F.lit(0.0)
    return features.select(
        "*",
        diversity.alias("genre_diversity"),
        F.when(
            F.col("avg_rating") > 0, F.try_divide(F.coalesce(F.col("rating_std"), zero), F.col("avg_rating"))
        ).otherwise(zero).alias("rating_consistency"),
        ((F.col("max_rating") - F.col("min_rating")) / F.lit(9.0)).alias("preference_intensity"),
        F.when(
            F.col("user_total_entries") > 0, F.try_divide(F.col("user_dropped"), F.col("user_total_entries"))
        ).otherwise(zero).alias("drop_rate"),
        binary_label(F.col("Gender"), "Male").alias("gender_encoded"),
        *[
            F.coalesce(F.try_divide(F.col(c), F.col("total_ratings")), zero).alias(s)
            for c, s in zip(counts, shares)
        ],
    )


def binary_label(column, zero_value: str):
    """0 for ``zero_value``, 1 for everything else."""
    return F.when(column == zero_value, 0).otherwise(1)


def scaled_features(
    features: DataFrame, columns: Sequence[str] = SCALED_COLUMNS, fit_on: DataFrame | None = None
) -> DataFrame:
    """Min-max scaled copies named ``<column>_normalized``, fitted on ``fit_on`` or on all rows."""
    fit = fit_columns(features if fit_on is None else fit_on, bounds=columns)
    return scale(features, columns, [f"{c}_normalized" for c in columns], fit)
