import hashlib
import math

import pytest
from pyspark.sql import functions as F

from ratelens.operators.bootstrap import (
    classification_intervals,
    intervals,
    poisson_cuts,
    regression_intervals,
    replicate_sums,
)

ROWS = [(i, i % 7, (i * 37 % 100) / 10.0, (i * 53 % 100) / 10.0) for i in range(400)]
SCHEMA = "a int, b int, y double, prediction double"


def weight(text, replicate, seed=42):
    block, j = divmod(replicate - 1, 4)
    draw = int(hashlib.md5(f"{seed}:{block}:{text}".encode()).hexdigest()[8 * j : 8 * j + 8], 16)
    return sum(draw >= cut for cut in poisson_cuts())


def plain(rows, replicate):
    weights = [1 if replicate == 0 else weight(f"{a}:{b}", replicate) for a, b, _, _ in rows]
    return sum(weights), sum(w * (y - p) ** 2 for w, (_, _, y, p) in zip(weights, rows))


def sums_of(df, replicates=10):
    error = F.col("y") - F.col("prediction")
    return replicate_sums(df, ["a", "b"], {"squared": error * error}, replicates)


def test_replicates_equal_a_plain_version_in_any_partitioning(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for parts in (1, 7):
        found = {r["replicate"]: (r["n"], r["squared"]) for r in sums_of(df.repartition(parts)).collect()}
        assert sorted(found) == list(range(11))
        for replicate, (n, squared) in found.items():
            expected = plain(ROWS, replicate)
            assert n == expected[0] and squared == pytest.approx(expected[1])


def test_weights_have_mean_and_variance_one():
    drawn = [weight(str(i), r) for i in range(2000) for r in range(1, 9)]
    mean = sum(drawn) / len(drawn)
    assert abs(mean - 1) < 0.03
    assert abs(sum((w - mean) ** 2 for w in drawn) / len(drawn) - 1) < 0.06


def test_interval_is_that_of_the_replicates(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = {r["metric"]: r for r in regression_intervals(df, "y", ["a", "b"], replicates=40).collect()}
    rmse = sorted(math.sqrt(s / n) for n, s in (plain(ROWS, r) for r in range(1, 41)))
    at = 0.025 * 39
    low = rmse[int(at)] + (at - int(at)) * (rmse[int(at) + 1] - rmse[int(at)])
    n, squared = plain(ROWS, 0)
    assert found["rmse"]["estimate"] == pytest.approx(math.sqrt(squared / n))
    assert found["rmse"]["low"] == pytest.approx(low)
    assert all(r["low"] < r["estimate"] < r["high"] and r["replicates"] == 40 for r in found.values())


def test_classes_nulls_repeats_and_empty_tables(spark):
    rows = [(i % 50, i % 2, float(i % 3 == 1)) for i in range(200)] + [(None, None, 1.0), (None, 1, None), (None, 1, 1.0)]
    df = spark.createDataFrame(rows, "a int, y int, prediction double")
    found = {r["metric"]: r for r in classification_intervals(df, "y", ["a"], replicates=20).collect()}
    kept = [(y, int(p)) for _, y, p in rows if y is not None and p is not None]
    assert found["accuracy"]["estimate"] == pytest.approx(sum(y == p for y, p in kept) / len(kept))
    hits = sum(y == p == 1 for y, p in kept)
    assert found["f1"]["estimate"] == pytest.approx(2 * hits / (sum(y for y, _ in kept) + sum(p for _, p in kept)))
    none = classification_intervals(df.limit(0), "y", ["a"], replicates=20).collect()
    assert [(r["metric"], r["estimate"], r["low"], r["replicates"]) for r in none] == [("accuracy", None, None, 0), ("f1", None, None, 0)]


def test_clashing_names_of_other_columns_do_no_harm(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"n": F.lit("x"), "replicate": F.lit("y"), "squared": F.lit("z")})
    assert sorted(sums_of(df).collect()) == sorted(sums_of(spark.createDataFrame(ROWS, SCHEMA)).collect())


def test_replicates_shuffle_only_partial_sums(spark):
    plan = intervals(sums_of(spark.createDataFrame(ROWS, SCHEMA)), {"n": F.col("n")})._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert plan.count("Exchange hashpartitioning(replicate") == 1
