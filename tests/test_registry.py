"""The registered queries against DuckDB, and the plans that matter at scale."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ratelens.checks.oracle import oracles
from ratelens.checks.registry import registered, retail_star
from ratelens.plans import business
from tools.compare import TABLES, compare

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODELS = {"regression_leaderboard", "classification_leaderboard", "classification_report"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIRECTORY}/{name}.parquet'")
    return connection


def test_every_query_but_training_has_sql():
    assert set(registered()) - set(oracles()) == MODELS
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(set(registered()) - MODELS))
def test_query_equals_its_sql(spark, connection, key):
    outcome, _ = compare(spark, connection, key, DIRECTORY)
    assert outcome.startswith("same"), outcome


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_needed_columns(spark):
    plan = plan_of(business.high_rating_share_by_source(retail_star(spark, DIRECTORY)))
    assert "ReadSchema: struct<Anime_SK:bigint,Is_High_Rating:int>" in plan
    assert "ReadSchema: struct<Anime_SK:bigint,Source:string>" in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(business.fan_ratings_of_type(retail_star(spark, DIRECTORY)))
    assert "EqualTo(Is_Above_Average,1)" in plan and "EqualTo(Type,Movie)" in plan


def test_fact_is_aggregated_before_it_meets_a_dimension(spark):
    plan = plan_of(business.avg_rating_by_genre(retail_star(spark, DIRECTORY)))
    assert plan.index("Join") < plan.index("Generate")  # genres are exploded below the join, on titles


def test_top_k_is_not_a_total_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(business.top_locations_fans(retail_star(spark, DIRECTORY)))


@pytest.mark.parametrize("name", sorted(set(business.QUERIES)))
def test_no_query_ranks_rows_of_a_table_in_one_task(spark, name):
    """A window over one partition may only see the per-task summaries."""
    plan = plan_of(business.QUERIES[name](retail_star(spark, DIRECTORY)))
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1] or "TakeOrdered" in lines[i + 1], plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
