from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ratelens.session import stored
from ratelens.operators import trees
from ratelens.plans.extra_trees import ExtraTreesRegressor


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = []
    for k in range(400):
        x = [rng.random(), float(rng.randint(0, 3)), 1.0, round(rng.random(), 1)]
        out.append((k, x, round(10 * x[0] + x[1] + rng.random() / 10, 3)))
    return spark.createDataFrame(out, "id bigint, x array<double>, label double").repartition(3)


def plain(rows, tree, node, seed):
    """The nodes of one tree, as ``{node: (feature, cut)}``, and what ends in each leaf."""
    if len({y for _, y in rows}) == 1:
        return {}, {node: rows}
    best = None
    for f in range(len(rows[0][0])):
        low, high = min(x[f] for x, _ in rows), max(x[f] for x, _ in rows)
        if low == high:
            continue
        cut = low + (high - low) * trees._draw(seed, tree, node, f)
        left = [y for x, y in rows if x[f] <= cut]
        right = [y for x, y in rows if x[f] > cut]
        if left and right:
            gain = float(sum(left)) ** 2 / len(left) + float(sum(right)) ** 2 / len(right)
            if best is None or gain > best[0]:
                best = (gain, f, cut)
    if best is None:
        return {}, {node: rows}
    _, f, cut = best
    out, leaves = {node: (f, cut)}, {}
    for child, side in enumerate(([r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut])):
        more, ends = plain(side, tree, 2 * node + child, seed)
        out |= more
        leaves |= ends
    return out, leaves


def nodes_of(forest):
    out = {(r["tree"], r["node"]): (r["feature"], r["cut"]) for r in forest.splits.collect()}
    for r in forest.subtrees.collect():
        todo = [(0, r["node"])]
        while todo:
            at, node = todo.pop()
            if r["lefts"][at] >= 0:
                out[r["tree"], node] = (r["features"][at], r["cuts"][at])
                todo += [(r["lefts"][at] + c, 2 * node + c) for c in range(2)]
    return out


@pytest.mark.parametrize("local_rows", [20, 150, 4096])
def test_equals_plain_trees_wherever_they_are_grown(rows, local_rows):
    """Levels by aggregations and subtrees by one task give the same trees."""
    training = rows.select("x", trees.in_units(F.col("label")).alias("y"))
    forest = trees.grow(training, 3, seed=7, local_rows=local_rows)
    assert (forest.levels > 0) == (local_rows < 400)
    expected, data = {}, [(r["x"], r["y"]) for r in training.collect()]
    means = {}
    for tree in range(3):
        splits, leaves = plain(data, tree, 1, 7)
        expected |= {(tree, node): split for node, split in splits.items()}
        for own in leaves.values():
            for x, _ in own:
                means.setdefault(tuple(x), []).append(sum(y for _, y in own) / len(own) * 1e-6)
    found = nodes_of(forest)
    assert found.keys() == expected.keys()
    assert all(found[k] == (expected[k][0], pytest.approx(expected[k][1])) for k in found)
    for r in trees.predict(rows, forest).join(rows, "id").collect():
        here = means[tuple(r["x"])]
        assert r["prediction"] == pytest.approx(sum(here) / len(here), abs=1e-8)
    counted = {r["feature"]: r["splits"] for r in trees.importances(forest).collect()}
    assert counted == {f: sum(v[0] == f for v in expected.values()) for f in counted} and 2 not in counted


def flagged(count=300):
    rng = random.Random(5)
    out = []
    for _ in range(count):
        x = [float(rng.random() < 0.2), rng.random(), 1.0, *[float(rng.random() < 0.1) for _ in range(20)], float(rng.randint(0, 2)), 0.0]
        out.append((x, round(1e6 * (x[0] + x[1] + x[5] + rng.random()))))
    return out


@pytest.mark.parametrize("local_rows", [40, 4096])
def test_features_of_zeros_and_ones_give_plain_trees(spark, local_rows):
    data = flagged()
    table = spark.createDataFrame(data, "x array<double>, y bigint").repartition(3)
    found, expected = nodes_of(trees.grow(table, 2, seed=7, local_rows=local_rows)), {}
    for tree in range(2):
        expected |= {(tree, node): split for node, split in plain(data, tree, 1, 7)[0].items()}
    assert {k: f for k, (f, _) in found.items()} == {k: f for k, (f, _) in expected.items()}
    assert all(found[k][1] == pytest.approx(expected[k][1]) for k in found)


def test_dealt_rows_have_a_bit_for_a_feature_of_zeros_and_ones(spark):
    """Before, a row had eight bytes for each feature, 200 here."""
    data = flagged()
    table = trees.encode(spark.createDataFrame(data, "x array<double>, y bigint"))
    layout = trees.layout_of(table, 25)
    assert layout.others.tolist() == [1, 23]
    rows = trees.packed(table, layout)
    sent = trees.deal(rows, [trees.top_of([])], [0], set(), layout.size, whole=layout.whole).collect()
    assert sum(len(r["x"]) for r in sent) == len(data) * 19
    x = np.concatenate([layout.whole(np.frombuffer(r["x"], np.uint8).reshape(-1, 19)) for r in sent])
    assert sorted(x.tolist()) == sorted(x for x, _ in data)


def test_cuts_of_zeros_and_ones_are_drawn_for_the_best_one_alone(monkeypatch):
    data, drawn = flagged(), []
    x, y = np.array([x for x, _ in data]), np.array([y for _, y in data])
    draw_all = trees.draw_all
    monkeypatch.setattr(trees, "draw_all", lambda *a: drawn.extend(a[3].tolist()) or draw_all(*a))
    layout = trees.Layout.of(trees.are_flags(x))
    trees.finish(*layout.parts(layout.pack(x)), layout, y, 0, 1, 7, 2)
    nodes = plain(data, 0, 1, 7)[0]
    assert sum(f in layout.flags for f in drawn) == sum(f in layout.flags for f, _ in nodes.values()) > 5


def test_predictions_of_rows_that_differ_in_their_zeros_and_ones(spark):
    data = flagged()
    table = spark.createDataFrame(data, "x array<double>, y bigint")
    forest = trees.grow(table, 3, seed=7)
    rows = [(k, x if k % 2 else [*x[:3], *[0.5] * 20, *x[23:]]) for k, (x, _) in enumerate(data)]
    mixed = spark.createDataFrame(rows, "id bigint, x array<double>").repartition(4)
    one = {r["id"]: r["prediction"] for r in trees.predict(mixed, forest).collect()}
    splits = [{node: split for (tree, node), split in nodes_of(forest).items() if tree == t} for t in range(3)]
    leaves = {}
    for r in forest.subtrees.collect():
        todo = [(0, r["node"])]
        while todo:
            at, node = todo.pop()
            leaves[r["tree"], node] = r["sums"][at] * 1e-6 / r["n"][at]
            if r["lefts"][at] >= 0:
                todo += [(r["lefts"][at] + c, 2 * node + c) for c in range(2)]
    for k, x in rows:
        total = 0.0
        for tree, inner in enumerate(splits):
            node = 1
            while node in inner:
                node = 2 * node + (x[inner[node][0]] > inner[node][1])
            total += leaves[tree, node]
        assert one[k] == pytest.approx(total / 3, abs=1e-8)


def test_a_large_node_without_a_cut_is_a_leaf(spark):
    same = spark.range(50).select(F.array(F.lit(1.0)).alias("x"), F.col("id").alias("y"))
    forest = trees.grow(same, 2, local_rows=10)
    assert forest.splits.count() == 0 and [r["n"] for r in forest.subtrees.collect()] == [[50], [50]]
    assert trees.predict(same.withColumnRenamed("y", "id"), forest).first()["prediction"] == pytest.approx(24.5e-6)


def test_stage_beats_a_constant_agrees_with_reruns_and_is_loaded(spark, rows, tmp_path):
    table = rows.select("label", *[F.get("x", F.lit(f)).alias(f"f{f}") for f in range(4)])
    train, test = table.filter("hash(f0) % 3 <> 0"), table.filter("hash(f0) % 3 = 0")
    stages = [
        VectorAssembler(inputCols=[f"f{f}" for f in range(4)], outputCol="features"),
        ExtraTreesRegressor(labelCol="label", numTrees=10, localRows=100, seed=3),
    ]
    model = Pipeline(stages=stages).fit(train)
    order = lambda df: sorted((r["f0"], r["prediction"]) for r in df.collect())
    predicted = model.transform(test)
    assert predicted.columns == [*test.columns, "features", "prediction"]
    error = predicted.select(F.avg((F.col("label") - F.col("prediction")) ** 2), F.var_pop("label")).first()
    assert error[0] < 0.1 * error[1]
    assert order(Pipeline(stages=stages).fit(train.repartition(7)).transform(test)) == order(predicted)
    model.write().save(str(tmp_path / "model"))
    assert order(PipelineModel.load(str(tmp_path / "model")).transform(test)) == order(predicted)


def test_rows_are_never_sent_beside_their_nodes(spark, monkeypatch):
    """Rows look small to Spark, as their arrays compress well; with many nodes neither side is sent."""
    table = stored(spark.range(4000).select(F.array((F.col("id") % 7).cast("double"), F.lit(0.0), (F.col("id") % 2).cast("double")).alias("x"), (F.col("id") % 5).alias("y")), "rows")
    rows = trees.place(table, 3)
    found = {}
    for most in (1024, 0):
        monkeypatch.setattr(trees, "SENT_NODES", most)
        splits = stored(trees.best_splits(rows, 42), "level")
        below = trees.children(rows, splits)
        found[most] = sorted(map(str, below.collect())), sorted(map(str, splits.collect()))
        plan = below._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (most > 0) and "BuildLeft" not in plan
    assert found[0] == found[1024] and len(found[0][0]) == 12_000
