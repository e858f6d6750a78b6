"""Feature tables for predicting a title's score and a user's class."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.casting import to_double, to_known_whole
from ratelens.functions.text import duration_minutes, feature_name, year_in_text
from ratelens.functions.vocabulary import (
    AGE_RATINGS,
    FULL_VOCABULARY,
    GENRES,
    SOURCES,
    STUDIOS,
    TYPES,
    BehaviourVocabulary,
)
from ratelens.operators.behaviour import (
    PROFILE_COLUMNS,
    SCALED_COLUMNS,
    derived_features,
    scaled_features,
    user_behaviour,
    user_profile,
)
from ratelens.operators.encoding import category_indicators, encode, list_indicators
from ratelens.operators.sampling import seeded_sample, stratified_split
from ratelens.plans.preprocessing import Preprocessor, PreprocessorModel
from ratelens.session import stored

# Columns cast, imputed and scaled by the regression table.
COUNT_COLUMNS = ("Members", "Favorites", "Popularity", "Watching", "Completed", "On-Hold", "Dropped", "Ranked")
IMPUTED_COLUMNS = (
    "episodes_clean", "duration_minutes", "release_year",
    "Members", "Favorites", "Popularity", "Watching", "Completed", "On-Hold", "Dropped",
)
NORMALIZED_COLUMNS = ("Members", "Favorites", "Popularity", "Watching", "Completed")
EXTRACTED_COLUMNS = ("episodes_clean", "duration_minutes", "release_year")

INDICATOR_COLUMNS = tuple(
    feature_name(prefix, label)
    for prefix, labels in (
        ("genre", GENRES), ("type", TYPES), ("source", SOURCES), ("rating", AGE_RATINGS), ("studio", STUDIOS),
    )
    for label in labels
)
REGRESSION_IDS = ("anime_id", "Name", "Score")
CLASSIFICATION_IDS = ("user_id", "Gender", "gender_encoded")


def extract_numbers(titles: DataFrame, which_year: str = "last") -> DataFrame:
    """Scored titles with score, episodes, duration, year and count columns as numbers."""
    counts = [c for c in COUNT_COLUMNS if c in titles.columns]
    return titles.withColumns(
        {
            "Score": to_double(F.col("Score")),
            "episodes_clean": to_known_whole(F.col("Episodes").cast("string")),
            "duration_minutes": duration_minutes(F.col("Duration")),
            "release_year": year_in_text(F.col("Aired"), which_year),
            **{c: F.col(f"`{c}`").try_cast("double") for c in counts},
        }
    ).filter(F.col("Score") > 0)


def title_indicators(mode: str = "substring"):
    """All indicator columns of a title, in the order of ``INDICATOR_COLUMNS``."""
    return (
        list_indicators(F.col("Genres"), GENRES, "genre", mode),
        category_indicators(F.col("Type"), TYPES, "type"),
        category_indicators(F.col("Source"), SOURCES, "source"),
        category_indicators(F.col("Rating"), AGE_RATINGS, "rating"),
        list_indicators(F.col("Studios"), STUDIOS, "studio", mode),
    )


def fit_titles(titles: DataFrame, which_year: str = "last") -> PreprocessorModel:
    """Medians and bounds of raw titles, e.g. the train part, for ``regression_features``."""
    numbers = extract_numbers(titles, which_year)
    medians, bounds = ([c for c in some if c in numbers.columns] for some in (IMPUTED_COLUMNS, NORMALIZED_COLUMNS))
    # One fit for both: a median lies inside its column's bounds, so imputing cannot move them.
    return Preprocessor(medianCols=medians, scaledCols=bounds).fit(numbers)


def regression_features(
    titles: DataFrame,
    fit_rows: DataFrame | None = None,
    which_year: str = "last",
    mode: str = "substring",
    fitted: PreprocessorModel | None = None,
) -> DataFrame:
    """Id, name, score and 79 features per scored title.

    Medians and bounds are ``fitted``, or those of ``fit_rows`` (raw titles, e.g. the train part) or of all titles.
    """
    fitted = fitted or fit_titles(titles if fit_rows is None else fit_rows, which_year)
    scaled = fitted.transform(extract_numbers(titles, which_year))
    outputs = [f"{c.lower()}_normalized" for c in fitted.getOrDefault("scaledCols")]
    encoded = encode(scaled, *title_indicators(mode))
    return encoded.select(*REGRESSION_IDS, *EXTRACTED_COLUMNS, *outputs, *INDICATOR_COLUMNS)


@dataclass(frozen=True)
class UserSelection:
    """Which users enter the classification table."""

    classes: tuple[str, str] = ("Male", "Female")
    min_ratings: int = 10
    sample_users: int | None = None
    seed: int = 42


def user_table(
    ratings: DataFrame,
    users: DataFrame,
    titles: DataFrame,
    selection: UserSelection = UserSelection(),
    vocabulary: BehaviourVocabulary = FULL_VOCABULARY,
) -> DataFrame:
    """One row per user of known class with enough ratings: label, behaviour and profile features, not scaled.

    ``users`` has the raw columns with ``user_id`` as id. The table, one row per user, is stored once: fitting
    a scale on its lineage would aggregate all ratings a second time.
    """
    known = users.filter(F.col("Gender").isin(*selection.classes))
    if selection.sample_users:
        known = seeded_sample(known, selection.sample_users, "user_id", selection.seed)
    behaviour = user_behaviour(ratings, titles, vocabulary)
    enough = behaviour.filter(F.col("total_ratings") >= selection.min_ratings)
    return stored(derived_features(enough.join(user_profile(known), "user_id"), vocabulary), "user-features")


def classification_features(
    ratings: DataFrame,
    users: DataFrame,
    titles: DataFrame,
    selection: UserSelection = UserSelection(),
    vocabulary: BehaviourVocabulary = FULL_VOCABULARY,
) -> DataFrame:
    """``user_table`` with scaled copies of some columns, fitted on all its users."""
    filled = scaled_features(user_table(ratings, users, titles, selection, vocabulary)).fillna(0)
    return filled.select(*CLASSIFICATION_IDS, *classification_columns(vocabulary))


def split_classification_features(
    ratings: DataFrame,
    users: DataFrame,
    titles: DataFrame,
    selection: UserSelection = UserSelection(),
    vocabulary: BehaviourVocabulary = FULL_VOCABULARY,
) -> tuple[DataFrame, PreprocessorModel]:
    """The table of ``classification_features`` with ``split``, scaled by the users of the train part alone; and the fit."""
    table = user_table(ratings, users, titles, selection, vocabulary)
    labelled = stored(stratified_split(table, "user_id", "gender_encoded"), "user-splits")
    fitted = Preprocessor(scaledCols=SCALED_COLUMNS).fit(labelled.filter(F.col("split") == "train"))
    filled = fitted.transform(labelled).fillna(0)
    return filled.select(*CLASSIFICATION_IDS, *classification_columns(vocabulary), "split"), fitted


def classification_columns(vocabulary: BehaviourVocabulary = FULL_VOCABULARY) -> list[str]:
    """Names of all classification features in table order."""
    return [
        "total_ratings", "avg_rating", "rating_std", "min_rating", "max_rating", "unique_anime_count",
        *[feature_name("genre_count", g) for g in vocabulary.genres],
        *[feature_name("type_count", t) for t in vocabulary.types],
        *[feature_name("avg_rating", t) for t in vocabulary.types],
        *[name for _, name in PROFILE_COLUMNS],
        "genre_diversity", "rating_consistency", "preference_intensity", "drop_rate",
        *[feature_name("genre_pct", g) for g in vocabulary.genres],
        *[f"{c}_normalized" for c in SCALED_COLUMNS],
    ]


def feature_columns(df: DataFrame, excluded: tuple[str, ...]) -> list[str]:
    """All columns but ids and target."""
    return [c for c in df.columns if c not in excluded]
