from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelens.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    # Key 0 holds half of all rows.
    return spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"), "id", (F.col("id") % 10).alias("v")
    )


def test_group_stats_equal_the_window(skewed):
    stats = [F.avg("v").alias("mean"), F.count("*").alias("n")]
    result = joins.with_group_stats(skewed, "k", stats, ["id"], rows_per_slice=100)
    whole = Window.partitionBy("k")
    expected = skewed.withColumn("mean", F.avg("v").over(whole)).withColumn("n", F.count("*").over(whole))
    assert result.exceptAll(expected).isEmpty() and result.count() == 2000


def test_group_stats_need_no_window(skewed):
    result = joins.with_group_stats(skewed, "k", [F.avg("v").alias("m")], ["id"], rows_per_slice=100)
    assert "Window" not in result._jdf.queryExecution().executedPlan().toString()


def test_all_hot_keys_are_listed_with_their_slices(skewed):
    counts = skewed.groupBy("k").agg(F.count("*").alias("n"))
    assert [tuple(r) for r in joins.hot_keys(counts, "k", "n", 100).collect()] == [(0, 10)]
    assert joins.hot_keys(counts, "k", "n", 1).count() == counts.count()


def test_more_hot_keys_than_a_thousand_are_all_split(spark):
    rows = spark.range(12_000).select((F.col("id") % 1200).alias("k"), "id")
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert joins.hot_keys(counts, "k", "n", 5).filter("__slices = 2").count() == 1200
    result = joins.with_group_stats(rows, "k", [F.count("*").alias("n")], ["id"], rows_per_slice=5)
    assert result.filter("n = 10").count() == 12_000


def test_hot_rows_spread_over_slices(spark, skewed):
    seen = {}
    real = joins.sliced_join

    def spy(big, small, key, hot, spread_by, how="inner"):
        slices = F.coalesce(F.col("__slices"), F.lit(1))
        left = big.join(hot, key, "left").withColumn("s", F.pmod(F.xxhash64(*spread_by), slices))
        seen["largest"] = left.groupBy(key, "s").count().agg(F.max("count")).first()[0]
        return real(big, small, key, hot, spread_by, how)

    joins_sliced, joins.sliced_join = joins.sliced_join, spy
    try:
        joins.with_group_stats(skewed, "k", [F.count("*").alias("n")], ["id"], rows_per_slice=100).collect()
    finally:
        joins.sliced_join = joins_sliced
    assert seen["largest"] < 200


def test_attributes_join_the_groups(spark, skewed):
    names = spark.range(60).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    result = joins.with_group_stats(skewed, "k", [F.count("*").alias("n")], ["id"], 100, names)
    assert result.count() == 2000
    assert result.filter("name <> concat('n', k)").isEmpty()


def test_adaptive_execution_splits_a_hot_user_of_the_fact_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.rand().alias("x")
        )
        dim = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("sk"))
        joined = fact.join(dim, "k")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_group_stats_shuffle_the_rows_once(spark, skewed, tmp_path):
    setting, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    skewed.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    try:
        spark.conf.set(setting, "-1")
        result = joins.with_group_stats(rows, "k", [F.count("*").alias("n")], ["id"], rows_per_slice=100)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert result.count() == 2000
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 2  # of the rows, and of the groups


@pytest.mark.parametrize(("limit", "join"), [(30 * 28, "BroadcastHashJoin"), (29 * 28, "ShuffledHashJoin")])
def test_rows_left_of_a_dimension_are_counted_before_the_join(spark, skewed, monkeypatch, limit, join):
    """A plain join is planned without knowing how few rows a filter leaves, and sorts both sides."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    left = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).filter("k < 30")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result, expected = joins.join_selected(skewed, left, "k"), skewed.join(left, "k")
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "SortMergeJoin" not in plan
        assert result.exceptAll(expected).isEmpty() and result.count() == expected.count() > 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_known_group_stats_are_not_computed_again(skewed):
    known = skewed.groupBy("k").agg(F.count("*").alias("n"), F.count("*").alias("__rows"))
    expected = joins.with_group_stats(skewed, "k", [F.count("*").alias("n")], ["id"])
    for rows_per_slice in (100, 10_000):
        result = joins.with_group_stats(skewed, "k", (), ["id"], rows_per_slice, groups=known)
        assert result.exceptAll(expected).isEmpty() and result.count() == 2000
