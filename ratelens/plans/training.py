"""Model training and ranking, with MLlib and the forests of ``ratelens.operators``."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import feature_name
from ratelens.operators import bootstrap
from ratelens.plans.bagged_trees import BaggedTreesClassifier, BaggedTreesRegressor
from ratelens.plans.extra_trees import ExtraTreesRegressor
from ratelens.session import raise_if_stopped, stored
from ratelens.sources.readers import path_exists


@dataclass(frozen=True)
class ModelSpec:
    """A named estimator, built for a label column and a number of training rows."""

    name: str
    estimator: Callable[[str, int], object]
    standardize: bool = False


def regression_models(depth: int = 30, rounds: int = 100) -> list[ModelSpec]:
    """Random forest, extremely randomised trees, boosted trees and bagged trees."""
    trees = {"seed": 42, "featuresCol": "features"}
    return [
        ModelSpec(
            "Random Forest (n=100)",
            lambda y, n: BaggedTreesRegressor(labelCol=y, numTrees=100, maxDepth=depth, **trees),
        ),
        ModelSpec("Extra Trees (n=100)", lambda y, n: ExtraTreesRegressor(labelCol=y, featuresCol="features", numTrees=100, seed=42)),
        ModelSpec("Gradient Boosting", lambda y, n: GBTRegressor(labelCol=y, maxIter=rounds, maxDepth=3, maxMemoryInMB=1024, **trees)),
        ModelSpec(
            "Bagged Trees (n=10)",
            lambda y, n: BaggedTreesRegressor(labelCol=y, numTrees=10, maxDepth=depth, **trees),
        ),
    ]


def classification_models(depth: int = 30, rounds: int = 100) -> list[ModelSpec]:
    """Logistic regression, random forest and boosted trees."""
    return [
        ModelSpec(
            "Logistic Regression",
            # The loss is averaged over rows here, so 1 / n is a penalty of unit strength.
            lambda y, n: LogisticRegression(
                labelCol=y, featuresCol="features", maxIter=2000, regParam=1.0 / max(n, 1), tol=1e-4
            ),
            standardize=True,
        ),
        ModelSpec(
            "Random Forest (n=200)",
            lambda y, n: BaggedTreesClassifier(
                labelCol=y, featuresCol="features", numTrees=200, maxDepth=depth, featureSubsetStrategy="sqrt", seed=42
            ),
        ),
        ModelSpec("Gradient Boosting", lambda y, n: GBTClassifier(labelCol=y, featuresCol="features", maxIter=rounds, maxDepth=3, seed=42)),
    ]


@dataclass
class Ranking:
    """The leaderboard, best model first, the test predictions by model name and the failures."""

    leaderboard: DataFrame
    predictions: dict[str, DataFrame]
    best: str
    failures: dict[str, str]


def _pipeline(spec: ModelSpec, features: Sequence[str], label: str, rows: int) -> Pipeline:
    assembled = "raw_features" if spec.standardize else "features"
    stages = [VectorAssembler(inputCols=list(features), outputCol=assembled, handleInvalid="error")]
    if spec.standardize:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=False))
    return Pipeline(stages=[*stages, spec.estimator(label, rows)])


def model_key(spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str) -> str:
    """Digest of what a model depends on: columns, the estimator's parameters, and the training rows.

    The rows count by their number and the sum of their hashes, which is the same in any order.
    """
    rows = train.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(label, *[f"`{f}`" for f in features]).cast("decimal(38,0)")).alias("hash"),
    ).first()
    estimator = spec.estimator(label, rows["n"])
    params = sorted((p.name, str(v)) for p, v in estimator.extractParamMap().items() if not p.name.endswith("Col"))
    key = [type(estimator).__name__, spec.standardize, label, list(features), params, rows["n"], str(rows["hash"])]
    return hashlib.md5(repr(key).encode()).hexdigest()[:16]


def train_or_load(
    spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str, models_path: str | None
) -> tuple[PipelineModel, str]:
    """The stored model of the same estimator, columns and rows, or a newly trained and stored one."""
    path = None
    if models_path:
        digest = model_key(spec, train, features, label)
        path = f"{models_path}/{feature_name('model', spec.name)}-{digest}"
        if path_exists(train.sparkSession, f"{path}/metadata"):
            return PipelineModel.load(path), "Loaded"
    model = _pipeline(spec, features, label, train.count()).fit(train)
    if path:
        model.write().overwrite().save(path)
    return model, "Trained"


def regression_metrics(predictions: DataFrame, label: str) -> DataFrame:
    """RMSE, MAE and R2 in one pass."""
    actual = F.col(label).cast("double")
    error = actual - F.col("prediction")
    squared = F.avg(error * error)
    return predictions.agg(
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squared, F.var_pop(actual))).alias("r2"),
    )


def confusion(predictions: DataFrame, label: str) -> DataFrame:
    """Rows per actual and predicted class."""
    return predictions.groupBy(
        F.col(label).cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted")
    ).agg(F.count("*").alias("n"))


def classification_metrics(predictions: DataFrame, label: str, positive: int = 1) -> DataFrame:
    """Accuracy, and F1 of the positive class, from the confusion counts."""
    actual, predicted, n = F.col("actual"), F.col("predicted"), F.col("n")
    hits = F.sum(F.when((actual == positive) & (predicted == positive), n).otherwise(0))
    total = F.sum(F.when(actual == positive, n).otherwise(0)) + F.sum(F.when(predicted == positive, n).otherwise(0))
    return confusion(predictions, label).agg(
        F.try_divide(F.sum(F.when(actual == predicted, n).otherwise(0)), F.sum(n)).alias("accuracy"),
        F.coalesce(F.try_divide(hits * 2.0, total), F.lit(0.0)).alias("f1"),
    )


def classification_report(predictions: DataFrame, label: str, names: dict[int, str]) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    counts = confusion(predictions, label)
    n = F.col("n")
    labelled = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    per_role = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    n.alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("actual") == F.col("predicted"), n).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("bigint").alias("support"),
                    n.alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    sums = per_role.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    zero = F.lit(0.0)
    scores = sums.select(
        labelled[F.col("class")].alias("class"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("support")), zero).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("hits") * 2.0, F.col("predicted") + F.col("support")), zero
        ).alias("f1"),
        "support",
        "hits",
    )
    weight = F.col("support")
    total = F.sum(weight)
    accuracy = F.try_divide(F.sum("hits"), total)
    summary = scores.agg(
        F.struct(
            F.lit("accuracy").alias("class"), accuracy.alias("precision"), accuracy.alias("recall"),
            accuracy.alias("f1"), total.alias("support"),
        ).alias("a"),
        F.struct(
            F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
            F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support"),
        ).alias("m"),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[F.try_divide(F.sum(F.col(c) * weight), total).alias(c) for c in ("precision", "recall", "f1")],
            total.alias("support"),
        ).alias("w"),
    ).select(F.inline(F.array("a", "m", "w")))
    return scores.drop("hits").unionByName(summary)


def train_and_rank(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    specs: Sequence[ModelSpec],
    metrics: Callable[[DataFrame, str], DataFrame],
    best_first: str,
    descending: bool,
    models_path: str | None = None,
    key: Sequence[str] = (),
    intervals: Callable[[DataFrame, str, Sequence[str]], DataFrame] | None = None,
    leave_out: bool = False,
) -> Ranking:
    """Train or load every model, measure it on ``test`` and rank by one metric.

    With ``key``, the columns that identify a row, predictions keep these and the leaderboard has the bounds that
    ``intervals`` gives for the metric, drawn alike for all models.

    A model that fails ends the ranking, as the best of the others would pass for the best of all; with ``leave_out`` it
    is left out and reported in ``failures``. The leaderboard has one row per model, so ordering it and naming the best
    one moves a handful of rows.
    """
    spark = train.sparkSession
    # Trees read the training rows once per level; storage beyond memory goes to executor disk.
    train = train.persist()
    rows, predictions, failures = [], {}, {}
    try:
        for spec in specs:
            start = time.monotonic()
            try:
                model, status = train_or_load(spec, train, features, label, models_path)
                # Stored, as metrics, intervals and a report would each predict all rows anew.
                predicted = stored(model.transform(test).select(*key, label, "prediction"), "predictions")
                measured = metrics(predicted, label).first().asDict()
                if key and intervals:
                    bounds = intervals(predicted, label, key).filter(F.col("metric") == best_first).first()
                    measured |= {f"{best_first}_low": bounds["low"], f"{best_first}_high": bounds["high"]}
            except Exception as error:
                raise_if_stopped(spark)
                if not leave_out:
                    raise RuntimeError(f"model {spec.name} failed: {error}") from error
                failures[spec.name] = str(error)
                continue
            predictions[spec.name] = predicted
            rows.append({"model": spec.name, **measured, "seconds": time.monotonic() - start, "status": status})
    finally:
        train.unpersist()
    if not rows:
        raise RuntimeError(f"no model could be trained: {failures}")
    kinds = {"model": "string", "status": "string"}
    schema = ", ".join(f"{name} {kinds.get(name, 'double')}" for name in rows[0])
    order = F.desc(best_first) if descending else F.asc(best_first)
    leaderboard = spark.createDataFrame([tuple(r.values()) for r in rows], schema).orderBy(order, "model")
    pick = max if descending else min
    best = pick(rows, key=lambda r: r[best_first])["model"]
    return Ranking(leaderboard, predictions, best, failures)


def rank_regressors(
    train, test, features, label="Score", models_path=None, specs=None, key=(), leave_out=True
) -> Ranking:
    """Regression models by RMSE, lowest first, with its interval when rows have a ``key``."""
    specs = specs or regression_models()
    return train_and_rank(
        train, test, features, label, specs, regression_metrics, "rmse", False, models_path,
        key, bootstrap.regression_intervals, leave_out,
    )


def rank_classifiers(
    train, test, features, label="gender_encoded", models_path=None, specs=None, key=(), leave_out=True
) -> Ranking:
    """Classification models by F1 of the positive class, highest first, with its interval when rows have a ``key``."""
    specs = specs or classification_models()
    return train_and_rank(
        train, test, features, label, specs, classification_metrics, "f1", True, models_path,
        key, bootstrap.classification_intervals, leave_out,
    )
