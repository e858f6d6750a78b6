from __future__ import annotations

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ratelens.checks import registry
from ratelens.plans import training


def small_regressors():
    return [s for s in training.regression_models(depth=4) if s.name.startswith(("Bagged", "Gradient"))]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b")
    )
    df = df.withColumn("y", F.col("a") * 2 + F.col("b")).withColumn("label", (F.col("a") > 8).cast("int"))
    return df.filter("id % 4 > 0"), df.filter("id % 4 = 0")


def test_regression_metrics(spark):
    predictions = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, prediction double")
    row = training.regression_metrics(predictions, "y").first()
    assert (row.rmse, row.mae, row.r2) == (pytest.approx((2 / 3) ** 0.5), pytest.approx(2 / 3), pytest.approx(0.75))


@pytest.fixture(scope="module")
def predicted(spark):
    rows = [(1, 1.0)] * 3 + [(1, 0.0)] + [(0, 1.0)] * 2 + [(0, 0.0)] * 4
    return spark.createDataFrame(rows, "label int, prediction double")


def test_classification_metrics(predicted):
    row = training.classification_metrics(predicted, "label").first()
    assert row.accuracy == pytest.approx(0.7) and row.f1 == pytest.approx(2 * 3 / (5 + 4))


def test_report(predicted):
    got = {r["class"]: r for r in training.classification_report(predicted, "label", {0: "no", 1: "yes"}).collect()}
    assert (got["yes"].precision, got["yes"].recall, got["yes"].support) == (0.6, 0.75, 4)
    assert got["no"].precision == 0.8 and got["no"].recall == pytest.approx(4 / 6)
    assert got["accuracy"].f1 == 0.7 and got["accuracy"].support == 10
    assert got["macro avg"].recall == pytest.approx((0.75 + 4 / 6) / 2)
    assert got["weighted avg"].precision == pytest.approx((0.6 * 4 + 0.8 * 6) / 10)


def test_a_class_never_predicted_scores_zero(spark):
    predictions = spark.createDataFrame([(1, 0.0), (0, 0.0)], "label int, prediction double")
    got = {r["class"]: r for r in training.classification_report(predictions, "label", {0: "no", 1: "yes"}).collect()}
    assert (got["yes"].precision, got["yes"].recall, got["yes"].f1) == (0.0, 0.0, 0.0)


def test_models_beat_a_constant_and_are_reused(data, tmp_path):
    train, test = data
    path = str(tmp_path / "models")
    first = training.rank_regressors(train, test, ["a", "b"], "y", path, small_regressors())
    again = training.rank_regressors(train, test, ["a", "b"], "y", path, small_regressors())
    board = first.leaderboard.collect()
    assert all(r.r2 > 0.5 for r in board) and [r.rmse for r in board] == sorted(r.rmse for r in board)
    assert first.best == board[0].model and {r.status for r in board} == {"Trained"}
    reloaded = again.leaderboard.collect()
    assert {r.status for r in reloaded} == {"Loaded"} and [r.rmse for r in reloaded] == [r.rmse for r in board]


def test_other_features_do_not_load_the_stored_model(data, tmp_path):
    train, test = data
    path = str(tmp_path / "models")
    specs = small_regressors()[:1]
    training.rank_regressors(train, test, ["a", "b"], "y", path, specs)
    other = training.rank_regressors(train, test, ["a"], "y", path, specs)
    assert other.leaderboard.first().status == "Trained"


def test_a_failing_model_is_left_out(data):
    train, test = data
    broken = training.ModelSpec("Broken", lambda y, n: LinearRegression(labelCol="missing"))
    ranking = training.rank_regressors(train, test, ["a", "b"], "y", specs=[broken, *small_regressors()[:1]])
    assert ranking.leaderboard.count() == 1 and list(ranking.failures) == ["Broken"]
    with pytest.raises(RuntimeError):
        training.rank_regressors(train, test, ["a"], "y", specs=[broken])


@pytest.mark.parametrize("name", ["classification_leaderboard", "classification_report"])
def test_a_failing_model_fails_the_query(spark, data, monkeypatch, tmp_path, name):
    train, test = (df.withColumnRenamed("id", "user_id").withColumnRenamed("label", "gender_encoded") for df in data)
    table = train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test"))).withColumn("Gender", F.lit("Male"))
    specs = [training.ModelSpec("Quick", lambda y, n: LogisticRegression(labelCol=y, featuresCol="features", maxIter=2))]
    broken = training.ModelSpec("Broken", lambda y, n: LinearRegression(labelCol="missing"))
    monkeypatch.setattr(registry, "_split_users", lambda spark, directory: table)
    monkeypatch.setattr(training, "classification_models", lambda: [*specs, broken])
    with pytest.raises(RuntimeError, match="Broken"):
        registry.registered()[name](spark, str(tmp_path))
    monkeypatch.setattr(training, "classification_models", lambda: specs)
    assert registry.registered()[name](spark, str(tmp_path)).count() == (1 if name.endswith("leaderboard") else 5)


def test_classifiers_rank_by_f1(data):
    train, test = data
    specs = [s for s in training.classification_models(depth=4) if "Forest" not in s.name]
    ranking = training.rank_classifiers(train, test, ["a", "b"], "label", specs=specs)
    board = ranking.leaderboard.collect()
    assert [r.f1 for r in board] == sorted((r.f1 for r in board), reverse=True) and board[0].accuracy > 0.9
    report = training.classification_report(ranking.predictions[ranking.best], "label", {0: "no", 1: "yes"})
    assert report.count() == 5


def test_the_default_models():
    assert [s.name for s in training.regression_models()] == [
        "Random Forest (n=100)", "Extra Trees (n=100)", "Gradient Boosting", "Bagged Trees (n=10)"
    ]
    assert training.regression_models()[0].estimator("y", 10).getNumTrees() == 100
    assert training.classification_models()[1].estimator("y", 10).getNumTrees() == 200
    assert training.classification_models()[0].estimator("y", 10).getRegParam() == 0.1
