"""The three flows from raw CSV inputs to results: queries, regression and classification."""

from __future__ import annotations

import datetime
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.sampling import class_balance, random_split, split_report
from ratelens.operators.star import TITLE_COLUMNS, USER_COLUMNS, Star, build_star
from ratelens.plans.business import with_totals
from ratelens.plans.features import (
    CLASSIFICATION_IDS,
    REGRESSION_IDS,
    UserSelection,
    feature_columns,
    fit_titles,
    regression_features,
    split_classification_features,
)
from ratelens.plans.preprocessing import PreprocessorModel
from ratelens.plans.runner import BATCHES, run_batch
from ratelens.plans.training import Ranking, classification_report, rank_classifiers, rank_regressors
from ratelens.sources.ingest import ingest_csv, input_manifest
from ratelens.sources.readers import load_split, require_inputs, with_standard_names
from ratelens.sources.writers import (
    ensure_star,
    materialize,
    write_csv,
    write_dataset,
    write_dataset_info,
    write_metadata,
    write_numeric_statistics,
)

# Input files and the aliases their id columns may have.
USERS_FILE = "users-details-2023.csv"
TITLES_FILE = "anime-dataset-2023.csv"
RATINGS_FILE = "users-score-2023.csv"
FILTERED_TITLES_FILE = "anime-filtered.csv"
USER_ALIASES = {"user_id": ["Mal ID", "uid", "id"], "Gender": []}
RATING_ALIASES = {"user_id": ["UID", "Mal ID"], "anime_id": ["Anime ID", "id"]}
TITLE_ALIASES = {"anime_id": ["id"], "Genres": [], "Type": [], "Score": []}

_RATING_KINDS = {"user_id": "bigint", "anime_id": "bigint", "rating": "int"}
_USER_KINDS = {source: kind for source, _, kind in USER_COLUMNS if kind != "date"} | {"Rewatched": "int"}
_SPLITS = ("train", "validation", "test")


# Kinds of the columns that the flows read from each file; all others are text.
_TITLE_KINDS = {source: kind for source, _, kind in TITLE_COLUMNS}


def read_users(spark: SparkSession, data: str, ingested: str) -> DataFrame:
    users = ingest_csv(spark, f"{data}/{USERS_FILE}", f"{ingested}/users", _USER_KINDS)
    return with_standard_names(users, USER_ALIASES)


def read_ratings(spark: SparkSession, data: str, ingested: str) -> DataFrame:
    """Ratings hold numbers and plain names, so the file can be split among tasks."""
    ratings = ingest_csv(spark, f"{data}/{RATINGS_FILE}", f"{ingested}/ratings", multi_line=False)
    ratings = with_standard_names(ratings, RATING_ALIASES)
    return ratings.select(*[F.col(c).try_cast(kind).alias(c) for c, kind in _RATING_KINDS.items()])


def read_filtered_titles(spark: SparkSession, data: str, ingested: str) -> DataFrame:
    titles = ingest_csv(spark, f"{data}/{FILTERED_TITLES_FILE}", f"{ingested}/filtered_titles", {"anime_id": "bigint"})
    return with_standard_names(titles, TITLE_ALIASES)


def _inputs(spark: SparkSession, data: str, *files: str) -> dict:
    """What a result built from these files depends on: the folder, and the files as they are now."""
    return {"data": data, "inputs": input_manifest(spark, [f"{data}/{f}" for f in files])}


def csv_star(spark: SparkSession, data: str, path: str, load_date: str | None = None) -> Star:
    """The star stored at ``path``, built from the CSV inputs under ``data`` on first use and when these have changed.

    Typed copies of the inputs and their rows at fault are under ``<path>.ingested``.
    """
    files, ingested = (USERS_FILE, TITLES_FILE, RATINGS_FILE), f"{path}.ingested"

    def build() -> Star:
        require_inputs(spark, [f"{data}/{f}" for f in files])
        return build_star(
            ingest_csv(spark, f"{data}/{USERS_FILE}", f"{ingested}/users", _USER_KINDS),
            ingest_csv(spark, f"{data}/{TITLES_FILE}", f"{ingested}/titles", _TITLE_KINDS),
            read_ratings(spark, data, ingested),
            load_date=load_date,
        )

    load_date = load_date or datetime.date.today().isoformat()
    return ensure_star(spark, path, build, _inputs(spark, data, *files) | {"load_date": load_date})


def run_business(spark: SparkSession, data: str, output: str, load_date: str | None = None) -> DataFrame:
    """Star, profile of the titles and all query batches; returns the status of every query."""
    star = csv_star(spark, data, f"{output}/star_schema", load_date)
    write_dataset_info(star.dim_anime, f"{output}/results")
    write_numeric_statistics(star.dim_anime, f"{output}/results")
    star = with_totals(star)
    statuses = [run_batch(spark, star, batch, f"{output}/results/{batch}") for batch in BATCHES]
    combined = statuses[0]
    for status in statuses[1:]:
        combined = combined.unionByName(status)
    return combined


def _save_splits(labelled: DataFrame, output: str, metadata: dict, formats: str = "both") -> None:
    """Splits, their report and the metadata of a feature table that carries a ``split`` column."""
    spark = labelled.sparkSession
    for split in _SPLITS:
        write_dataset(labelled.filter(F.col("split") == split).drop("split"), f"{output}/{split}", formats)
    split_report(labelled).coalesce(1).write.mode("overwrite").json(f"{output}/split_info.json")
    write_metadata(spark, metadata, f"{output}/preprocessing_info.json")


def preprocessing_path(output: str) -> str:
    return f"{output}/preprocessing"


def load_preprocessing(output: str) -> PreprocessorModel:
    """What a flow has fitted on its train part, to prepare further rows alike."""
    return PreprocessorModel.load(preprocessing_path(output))


def prepare_regression(spark: SparkSession, data: str, output: str) -> DataFrame:
    """Feature table of the filtered titles, fitted on the train part and split 70/15/15."""

    def build() -> DataFrame:
        require_inputs(spark, [f"{data}/{FILTERED_TITLES_FILE}"])
        raw = random_split(read_filtered_titles(spark, data, f"{output}/ingested"), "anime_id")
        fitted = fit_titles(raw.filter(F.col("split") == "train"))
        fitted.write().overwrite().save(preprocessing_path(output))
        return random_split(regression_features(raw, fitted=fitted), "anime_id")

    table = materialize(spark, f"{output}/features", build, _inputs(spark, data, FILTERED_TITLES_FILE))
    names = feature_columns(table, (*REGRESSION_IDS, "split"))
    _save_splits(
        table,
        output,
        {"task": "regression", "target": "Score", "feature_count": len(names), "features": names,
         "total_samples": table.count()},
    )
    return table


def run_regression(spark: SparkSession, data: str, output: str, specs=None) -> Ranking:
    """Prepare, train, rank and save the leaderboard."""
    prepare_regression(spark, data, f"{output}/regression")
    train, test = (load_split(spark, f"{output}/regression", s) for s in ("train", "test"))
    features = feature_columns(train, REGRESSION_IDS)
    ranking = rank_regressors(
        train.fillna(0), test.fillna(0), features, models_path=f"{output}/models/regression", specs=specs, key=["anime_id"],
        leave_out=False,
    )
    write_csv(ranking.leaderboard, f"{output}/results/regression_leaderboard.csv", single_file=True)
    return ranking


def prepare_classification(
    spark: SparkSession, data: str, output: str, selection: UserSelection = UserSelection()
) -> DataFrame:
    """Feature table per user, split 70/15/15 within each class, scaled by the train part."""
    files, ingested = (USERS_FILE, RATINGS_FILE, FILTERED_TITLES_FILE), f"{output}/ingested"

    def build() -> DataFrame:
        require_inputs(spark, [f"{data}/{f}" for f in files])
        ratings, users = read_ratings(spark, data, ingested), read_users(spark, data, ingested)
        titles = read_filtered_titles(spark, data, ingested)
        table, fitted = split_classification_features(ratings, users, titles, selection)
        fitted.write().overwrite().save(preprocessing_path(output))
        return table

    parameters = _inputs(spark, data, *files) | {"selection": asdict(selection)}
    table = materialize(spark, f"{output}/features", build, parameters)
    names = feature_columns(table, (*CLASSIFICATION_IDS, "split"))
    balance = {row["Gender"]: row["row_count"] for row in class_balance(table, "Gender").collect()}  # two classes
    _save_splits(
        table,
        output,
        {"task": "classification", "target": "gender_encoded", "feature_count": len(names), "features": names,
         "total_samples": sum(balance.values()), "class_balance": balance,
         "min_ratings_threshold": selection.min_ratings},
    )
    return table


def run_classification(
    spark: SparkSession, data: str, output: str, selection: UserSelection = UserSelection(), specs=None
) -> tuple[Ranking, DataFrame]:
    """Prepare, train and rank; returns the ranking and the best model's report."""
    prepare_classification(spark, data, f"{output}/classification", selection)
    train, test = (load_split(spark, f"{output}/classification", s) for s in ("train", "test"))
    features = feature_columns(train, CLASSIFICATION_IDS)
    ranking = rank_classifiers(
        train.fillna(0), test.fillna(0), features, models_path=f"{output}/models/classification", specs=specs, key=["user_id"],
        leave_out=False,
    )
    names = dict(enumerate(selection.classes))
    report = classification_report(ranking.predictions[ranking.best], "gender_encoded", names)
    write_csv(ranking.leaderboard, f"{output}/results/classification_leaderboard.csv", single_file=True)
    write_csv(report, f"{output}/results/classification_report.csv", single_file=True)
    return ranking, report
