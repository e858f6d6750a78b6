from __future__ import annotations

import pytest

from ratelens.operators import profiling


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 2.0, "a", 5), (2, None, "b", 5), (3, 4.0, None, 5), (3, 4.0, None, 5)]
    return spark.createDataFrame(rows, "id int, x double, `odd name` string, same int")


def by_name(df):
    return {r.column_name: r for r in df.collect()}


def test_info_and_description(table):
    got = by_name(profiling.describe_dataset(table))
    assert [got[c].null_count for c in table.columns] == [0, 1, 2, 0]
    assert got["odd name"].null_percentage == 50.0 and got["odd name"].data_type == "string"
    assert {(r.row_count, r.column_count) for r in got.values()} == {(4, 4)}


def test_info_of_an_empty_table(table):
    got = by_name(profiling.describe_dataset(table.limit(0)))
    assert got["x"].row_count == 0 and got["x"].null_percentage == 0.0


def test_statistics_cover_numeric_columns_in_one_job(table):
    got = by_name(profiling.numeric_statistics(table))
    assert set(got) == {"id", "x", "same"}
    assert (got["x"]["count"], got["x"].min, got["x"].max, got["x"].null_count) == (3, 2.0, 4.0, 1)
    assert got["x"].mean == pytest.approx(10 / 3) and got["x"].null_percentage == 25.0
    assert got["same"].stddev == 0.0
    plan = profiling.numeric_statistics(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_statistics_without_numeric_columns(table):
    assert profiling.numeric_statistics(table.select("odd name")).isEmpty()


def test_assessment_bands(spark):
    rows = [
        ("none", 10, 10.0, 1.0, 8.0, 12.0, 0, 0.0),
        ("few", 10, 10.0, 2.0, 8.0, 12.0, 1, 4.9),
        ("some", 10, 10.0, 4.0, 8.0, 12.0, 1, 5.0),
        ("many", 10, 10.0, 0.0, 8.0, 8.0, 1, 20.0),
        ("centred", 10, 0.0, 1.0, -1.0, 1.0, 0, 0.0),
    ]
    got = by_name(profiling.assess_numeric(spark.createDataFrame(rows, profiling._STATS_SCHEMA)))
    assert [got[n].quality for n in ("none", "few", "some", "many")] == ["excellent", "good", "acceptable", "poor"]
    assert [got[n].spread for n in ("none", "few", "some", "many", "centred")] == ["low", "moderate", "high", None, None]
    assert got["many"].value_range == 0.0


def test_quality_report_counts_repeated_rows(table):
    report = profiling.quality_report(table).first()
    assert (report.row_count, report.duplicate_rows, report.null_cells) == (4, 1, 3)
    assert report.null_percentage == 18.75
    assert profiling.quality_report(table.limit(0)).first().row_count == 0


def test_sample_rows(table):
    assert [r.id for r in profiling.sample_rows(table, ["id"], 2).collect()] == [1, 2]


def test_quality_report_shuffles_digests_only(spark):
    rows = [(None, "a", 1), ("a", None, 1), ("a", None, 1), (None, None, 2)] + [("b", "c", 3)] * 40
    df = spark.createDataFrame(rows, "x string, y string, n int").repartition(3)
    report = profiling.quality_report(df)
    assert tuple(report.first())[:3] == (44, 40, 5)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    aggregate = [line for line in plan.splitlines() if "Aggregate [__one" in line][0]
    assert "x#" not in aggregate and "y#" not in aggregate
