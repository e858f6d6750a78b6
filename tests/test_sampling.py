from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ratelens.functions.hashing import seeded_hash
from ratelens.operators import sampling


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1000).select("id", F.when(F.col("id") % 10 < 7, "big").otherwise("small").alias("label"))


def members(df):
    return {(r.id, r.split) for r in df.select("id", "split").collect()}


@pytest.mark.parametrize(
    "split", [lambda df: sampling.random_split(df, "id"), lambda df: sampling.stratified_split(df, "id", "label")]
)
def test_splits_cover_the_input_and_do_not_depend_on_partitions(labelled, split):
    first, second = members(split(labelled)), members(split(labelled.repartition(7)))
    assert first == second and len(first) == 1000 and len({i for i, _ in first}) == 1000


def test_random_split_is_near_its_shares(labelled):
    sizes = {r.split: r.row_count for r in sampling.split_report(sampling.random_split(labelled, "id")).collect()}
    assert abs(sizes["train"] - 700) < 60 and abs(sizes["test"] - 150) < 50


def test_stratified_split_cuts_each_class_exactly(labelled):
    split = sampling.stratified_split(labelled, "id", "label")
    got = {(r.split, r.label): r.row_count for r in sampling.class_balance(split, "label", "split").collect()}
    expected = {}
    for label, n in (("big", 700), ("small", 300)):
        first, second = int(n * 0.70), int(n * (0.70 + 0.15))  # 489 and 595 of 700: the product is a double
        expected |= {("train", label): first, ("validation", label): second - first, ("test", label): n - second}
    assert got == expected


def test_a_class_of_one_row_is_kept(spark):
    df = spark.createDataFrame([(1, "only"), (2, "x"), (3, "x")], "id int, label string")
    split = sampling.stratified_split(df, "id", "label")
    assert split.count() == 3 and split.filter("label = 'only'").first().split == "test"
    assert sampling.stratified_split(df.limit(0), "id", "label").isEmpty()


def test_sample_has_n_rows_by_either_way(labelled, monkeypatch):
    small = {r.id for r in sampling.seeded_sample(labelled.repartition(3), 200, "id").collect()}
    large = {r.id for r in sampling.seeded_sample(labelled, 200, "id").collect()}
    assert small == large and len(small) == 200
    assert {r.id for r in sampling.seeded_sample(labelled, 200, "id", seed=1).collect()} != small
    assert sampling.seeded_sample(labelled, 5000, "id").count() == 1000


def test_sample_equals_the_full_order(labelled, monkeypatch):
    ordered = sorted((r.h, r.id) for r in labelled.select(seeded_hash(F.col("id")).alias("h"), "id").collect())
    for n in (0, 1, 10, 100):
        got = {r.id for r in sampling.seeded_sample(labelled, n, "id").collect()}
        assert got == {i for _, i in ordered[:n]}
    monkeypatch.setattr(sampling.math, "sqrt", lambda n: -n / 6)  # a cut that holds too few rows
    assert {r.id for r in sampling.seeded_sample(labelled, 100, "id").collect()} == {i for _, i in ordered[:100]}


def test_report_shares(labelled):
    report = sampling.split_report(sampling.stratified_split(labelled, "id", "label"))
    assert {r.split: r.share for r in report.collect()} == {"train": 0.699, "validation": 0.151, "test": 0.15}
