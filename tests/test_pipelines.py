from __future__ import annotations

import random

import pytest

from ratelens.functions.vocabulary import GENRES, TYPES
from ratelens.plans import pipelines, training
from ratelens.plans.features import UserSelection
from ratelens.sources.readers import load_split
from ratelens.sources.writers import read_metadata, write_csv
from rows import TITLE_SCHEMA, USER_SCHEMA, title, user


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    rng = random.Random(3)
    users = [user(i, "Male" if i % 2 else "Female", "USA", mean=7.0, completed=i, entries=9) for i in range(1, 41)]
    users.append(user(99, None))
    titles = [
        title(i, f"title {i}, part", str(round(rng.uniform(1, 10), 2)) if i % 9 else "UNKNOWN",
              f"{rng.choice(GENRES)}, {rng.choice(GENRES)}", rng.choice(TYPES), popularity=str(i), members=str(i * 100))
        for i in range(1, 121)
    ]
    ratings = [(i, t, rng.randint(1, 10)) for i in [*range(1, 41), 99] for t in rng.sample(range(1, 121), 15)]
    write_csv(spark.createDataFrame(users, USER_SCHEMA), f"{folder}/{pipelines.USERS_FILE}")
    for name in (pipelines.TITLES_FILE, pipelines.FILTERED_TITLES_FILE):
        write_csv(spark.createDataFrame(titles, TITLE_SCHEMA), f"{folder}/{name}")
    write_csv(
        spark.createDataFrame(ratings, "user_id int, anime_id int, rating int"), f"{folder}/{pipelines.RATINGS_FILE}"
    )
    return str(folder)


def test_business_flow(spark, data, tmp_path):
    status = pipelines.run_business(spark, data, str(tmp_path)).collect()
    assert len(status) == 25 and {r.status for r in status} == {"ok"}
    assert spark.read.parquet(f"{tmp_path}/star_schema/fact_user_ratings").count() == 41 * 15
    saved = spark.read.option("header", True).csv(f"{tmp_path}/results/genres_and_types/avg_rating_by_genre.csv")
    assert saved.columns == ["genre", "avg_user_rating", "rated_count"]
    assert spark.read.json(f"{tmp_path}/results/dataset_info.json").count() == 21


def test_flows_fail_on_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipelines.run_business(spark, str(tmp_path / "nothing"), str(tmp_path / "out"))


def test_regression_flow(spark, data, tmp_path):
    specs = [s for s in training.regression_models(depth=3) if s.name.startswith("Bagged")]
    ranking = pipelines.run_regression(spark, data, str(tmp_path), specs)
    assert ranking.leaderboard.count() == 1
    parts = [load_split(spark, f"{tmp_path}/regression", s) for s in ("train", "validation", "test")]
    assert sum(p.count() for p in parts) == 107 and len(parts[0].columns) == 82
    info = read_metadata(spark, f"{tmp_path}/regression/preprocessing_info.json")
    assert info["feature_count"] == 79 and info["total_samples"] == 107
    assert spark.read.json(f"{tmp_path}/regression/split_info.json").count() == 3
    assert spark.read.option("header", True).csv(f"{tmp_path}/results/regression_leaderboard.csv").count() == 1


def test_classification_flow(spark, data, tmp_path):
    specs = [s for s in training.classification_models(depth=3) if s.name == "Logistic Regression"]
    ranking, report = pipelines.run_classification(
        spark, data, str(tmp_path), UserSelection(min_ratings=10, sample_users=30), specs
    )
    assert ranking.best == "Logistic Regression"
    assert {"Male", "Female", "accuracy"} <= {r["class"] for r in report.collect()}
    info = read_metadata(spark, f"{tmp_path}/classification/preprocessing_info.json")
    assert info["total_samples"] == 30 and sum(info["class_balance"].values()) == 30
    assert spark.read.parquet(f"{tmp_path}/classification/features").count() == 30


def test_a_changed_csv_rebuilds_what_was_made_from_it(spark, tmp_path):
    """Star, features and models follow the files' content, not their folder."""
    data, out = tmp_path / "data", str(tmp_path / "out")
    rng = random.Random(5)

    def write(first):
        users = [user(i, "Male" if i % 2 else "Female", "USA", mean=7.0, completed=i, entries=9) for i in range(1, 31)]
        titles = [title(i, f"t{i}", str(first if i == 1 else round(rng.uniform(1, 10), 2))) for i in range(1, 61)]
        ratings = [(i, t, (i * t) % 10 + 1) for i in range(1, 31) for t in range(1, 16)]
        write_csv(spark.createDataFrame(users, USER_SCHEMA), f"{data}/{pipelines.USERS_FILE}")
        for name in (pipelines.TITLES_FILE, pipelines.FILTERED_TITLES_FILE):
            write_csv(spark.createDataFrame(titles, TITLE_SCHEMA), f"{data}/{name}")
        write_csv(spark.createDataFrame(ratings, "user_id int, anime_id int, rating int"), f"{data}/{pipelines.RATINGS_FILE}")

    spec = [s for s in training.regression_models() if s.name.startswith("Extra")]
    seen = []
    for first in (3.25, 3.25, 9.75):
        if not seen or first != 3.25:
            rng.seed(5)
            write(first)
        star = pipelines.csv_star(spark, str(data), f"{out}/star", "2024-01-02")
        ranking = pipelines.run_regression(spark, str(data), out, spec)
        features = spark.read.parquet(f"{out}/regression/features")
        seen.append((
            star.dim_anime.filter("Anime_ID = 1").first()["Avg_Score"],
            features.filter("anime_id = 1").first()["Score"],
            ranking.leaderboard.first()["status"],
        ))
    in_train = features.filter("anime_id = 1").first()["split"] == "train"
    assert seen[0] == (3.25, 3.25, "Trained") and seen[1] == (3.25, 3.25, "Loaded")
    assert seen[2] == (9.75, 9.75, "Trained" if in_train else "Loaded")


def test_preprocessing_is_fitted_on_the_train_part_and_stored(spark, data, tmp_path):
    table = pipelines.prepare_classification(spark, data, str(tmp_path), UserSelection(min_ratings=10))
    fitted = pipelines.load_preprocessing(str(tmp_path)).fitted["numbers"]
    train = table.filter("split = 'train'").agg({"user_completed": "max"}).first()[0]
    assert fitted["max user_completed"] == train
    assert table.filter("split = 'train'").agg({"user_completed_normalized": "max"}).first()[0] == 1.0
