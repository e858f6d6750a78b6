from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ratelens.operators import forests, trees
from ratelens.plans import training
from ratelens.plans.bagged_trees import BaggedTreesClassifier


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = []
    for k in range(400):
        x = [round(rng.random(), 3), float(rng.randint(0, 3)), 1.0, round(rng.random(), 1)]
        out.append((k, x, round(10 * x[0] + x[1] + rng.random() / 10, 3)))
    return spark.createDataFrame(out, "id bigint, x array<double>, label double").repartition(3)


def test_same_trees_wherever_they_are_grown(rows):
    training_rows = rows.select("x", trees.in_units(F.col("label")).alias("y"))
    found = []
    for local_rows, parts, some in ((10_000, 2, None), (60, 2, None), (60, 5, None)):
        table = training_rows.repartition(parts, "y") if some is None else training_rows
        forest = forests.grow(table, 4, seed=7, some=some, local_rows=local_rows, bins=1024)
        assert (forest.levels > 0) == (local_rows < 400)
        found.append({r["id"]: r["prediction"] for r in trees.predict(rows, forest).collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == 400
    label = {r["id"]: r["label"] for r in rows.collect()}
    errors = [(label[k] - v) ** 2 for k, v in found[0].items()]
    assert np.mean(errors) < 0.02 * np.var(list(label.values()))


def test_bags_are_poisson_numbers_of_the_rows_that_are_equal():
    hashes = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 40_000)
    for count in (1, 7, 3_000):
        drawn = forests.poisson_weights(hashes, np.full(len(hashes), count), 42, 3)
        assert abs(drawn.mean() / count - 1) < 0.02 and abs(drawn.var() / count - 1) < 0.05


def test_sparse_histograms_find_the_same_cuts():
    rng = np.random.default_rng(2)
    nodes, bins, m = 300, 32, 2_000
    owner = np.sort(np.concatenate([np.arange(nodes), rng.integers(0, nodes, m - nodes)]))
    w, y = rng.integers(1, 4, m).astype(float), rng.integers(-50, 50, m)
    keys, wy = owner * bins + rng.integers(0, bins, m), w * y
    n, total = np.bincount(owner, w), np.bincount(owner, wy)
    dense, sparse = (f(keys, w, wy, nodes, bins, n, total) for f in (forests._dense, forests._sparse))
    able = np.isfinite(dense[0])
    assert np.array_equal(dense[0], sparse[0]) and np.array_equal(dense[1][able], sparse[1][able])


def test_draws_at_once_are_those_of_one():
    nodes, features = np.array([1, 9, 10, 99, 12345, (1 << 60) + 1]), np.array([0, 9, 10, 83, 100, 7])
    for seed, tree in ((42, 0), (7, 123), (10**60, 5)):
        assert trees.draw_all(seed, tree, nodes, features).tolist() == [
            trees._draw(seed, tree, int(n), int(f)) for n, f in zip(nodes, features)
        ]


def test_forests_of_the_leaderboards_are_tables_and_not_held_by_the_driver():
    named = [*training.regression_models(), *training.classification_models()]
    kinds = {s.name: type(s.estimator("y", 10)).__module__ for s in named}
    assert all(kind.startswith("ratelens.") for name, kind in kinds.items() if "Forest" in name or "Trees" in name)


def test_classifier_beats_a_guess_and_is_loaded(spark, rows, tmp_path):
    table = rows.select((F.col("label") > 6).cast("int").alias("label"), *[F.get("x", F.lit(f)).alias(f"f{f}") for f in range(4)])
    stages = [
        VectorAssembler(inputCols=[f"f{f}" for f in range(4)], outputCol="features"),
        BaggedTreesClassifier(labelCol="label", numTrees=20, featureSubsetStrategy="sqrt", seed=3),
    ]
    train, test = table.filter("hash(f0) % 3 <> 0"), table.filter("hash(f0) % 3 = 0")
    model = Pipeline(stages=stages).fit(train)
    predicted = model.transform(test)
    assert predicted.filter("label = prediction").count() > 0.9 * test.count()
    order = lambda df: sorted((r["f0"], r["prediction"]) for r in df.collect())
    model.write().save(str(tmp_path / "model"))
    assert order(PipelineModel.load(str(tmp_path / "model")).transform(test)) == order(predicted)
    with pytest.raises(ValueError):
        Pipeline(stages=stages).fit(train.withColumn("label", F.lit(2)))
