from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelens.operators.ranking import dense_row_number, next_value, ntile, top_per_group


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(1)
    # One group holds most rows, one key value is NULL, many values tie.
    rows = [(i, rng.choice(["a", "a", "a", "a", "b", "c", None]), rng.choice([None, *range(20)])) for i in range(3000)]
    return spark.createDataFrame(rows, "id int, g string, v int").repartition(5)


def order():
    return [F.desc_nulls_last("v"), F.asc("id")]


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_global_row_number_equals_the_window(values):
    expected = values.withColumn("rn", F.row_number().over(Window.orderBy(*order())).cast("bigint"))
    assert same(dense_row_number(values, order(), output="rn"), expected)


def test_grouped_row_number_and_size_equal_the_window(values):
    window = Window.partitionBy("g")
    expected = values.withColumn("rn", F.row_number().over(window.orderBy(*order())).cast("bigint")).withColumn(
        "n", F.count("*").over(window)
    )
    assert same(dense_row_number(values, order(), ["g"], "rn", "n"), expected)


def test_a_group_is_sorted_by_several_tasks(values):
    from ratelens.operators.ranking import _store_sorted

    tasks = _store_sorted(values, ["g"], order()).filter(F.col("g") == "a").select("__task").distinct().count()
    assert tasks > 1


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 10, 23])
@pytest.mark.parametrize("buckets", [3, 5])
def test_ntile_equals_the_window(spark, n, buckets):
    df = spark.range(n).select("id", (F.col("id") % 2).alias("v"))
    by = [F.desc("v"), F.asc("id")]
    expected = df.withColumn("bucket", F.ntile(buckets).over(Window.orderBy(*by)))
    assert sorted(map(tuple, ntile(df, buckets, by, "bucket").collect())) == sorted(map(tuple, expected.collect()))


def test_next_value_equals_lead_also_across_tasks_and_nulls(values):
    expected = values.withColumn("nxt", F.lead("v").over(Window.orderBy(*order())))
    assert same(next_value(values, "v", order(), "nxt"), expected)


def test_top_per_group_limits_before_the_shuffle(values):
    top = top_per_group(values, ["g"], order(), 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.groupBy("g").count().filter("count > 3").isEmpty()


def test_only_the_per_task_summary_is_ranked_in_one_task(values):
    plan = dense_row_number(values, order(), output="rn")._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("Exchange SinglePartition"):]
    assert "HashAggregate" in single.split("\n")[1]
