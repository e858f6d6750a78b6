from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ratelens.operators.star import STAR_SCHEMAS, build_star, date_dimension, date_dimension_of, ratings_fact
from ratelens.sources import writers
from ratelens.sources.readers import load_star
from ratelens.sources.writers import ensure_star, save_star


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_user_keys_follow_the_id_and_dates_are_parsed(star):
    got = rows(star.dim_user.orderBy("User_SK"), "User_SK", "User_ID", "Birthday", "Joined_Date")
    assert [r[:2] for r in got] == [(1, 10), (2, 20), (3, 30), (4, 41), (5, 50)]
    assert got[2][3] == datetime.date(2022, 1, 1)
    assert got[3][2:] == (datetime.date(1985, 3, 4), None)


def test_unparsable_title_values_are_null(star):
    beta = star.dim_anime.filter("Name = 'Beta'").first()
    assert (beta.Avg_Score, beta.Episodes, beta.Popularity_Rank) == (None, None, None)
    assert [r[0] for r in rows(star.dim_anime.orderBy("Anime_SK"), "Anime_ID")] == [3, 5, 7, 9, 11, 13]




def test_default_calendar_has_every_day(spark):
    calendar = date_dimension(spark)
    assert calendar.count() == 9497
    day = calendar.filter("Date_SK = 20240229").first()
    assert day[1:] == (datetime.date(2024, 2, 29), 2024, 1, 2, "February", "Thursday", False)
    assert calendar.filter("Date_SK = 20240303").first().Is_Weekend


def test_fact_drops_unknown_ids_and_flags_null_scores_as_zero(star):
    fact = star.fact.join(star.dim_user, "User_SK").join(star.dim_anime, "Anime_SK")
    got = {(r.User_ID, r.Anime_ID): r for r in fact.collect()}
    assert len(got) == 12 and (99, 7) not in got and (30, 77) not in got
    unknown_score = got[(10, 5)]
    assert unknown_score.Rating_Deviation is None
    assert (unknown_score.Is_Above_Average, unknown_score.Is_Low_Rating, unknown_score.Is_High_Rating) == (0, 1, 0)
    assert got[(10, 3)].Is_Above_Average == 0 and got[(10, 3)].Rating_Deviation == 0.0
    assert got[(41, 3)].Is_High_Rating == 1
    assert {r.Date_SK for r in got.values()} == {20240229}


def test_days_outside_the_calendar_get_no_key(spark, star, ratings):
    dated = ratings.withColumn("day", F.when(F.col("rating") == 10, F.lit("1999-12-31")).otherwise("2001-02-03"))
    fact = ratings_fact(dated, star.dim_user, star.dim_anime, star.dim_date, "day")
    assert {tuple(r) for r in fact.select(F.col("User_Rating") == 10, "Date_SK").distinct().collect()} == {
        (True, None), (False, 20010203)
    }


def test_calendar_of_a_fact_covers_its_span(spark):
    fact = spark.createDataFrame([(20231230,), (20240102,), (None,)], "Date_SK int")
    assert [r[0] for r in rows(date_dimension_of(fact).orderBy("Date_SK"), "Date_SK")] == [
        20231230, 20231231, 20240101, 20240102
    ]
    assert date_dimension_of(fact.filter("Date_SK IS NULL")).isEmpty()


@pytest.mark.parametrize("dated", [False, True])
def test_saved_star_is_reused_without_building(spark, users, titles, ratings, tmp_path, dated):
    path = str(tmp_path / "star")
    ratings = ratings.withColumn("day", F.lit("2020-05-05"))
    built = []

    def build():
        built.append(1)
        return build_star(users, titles, ratings, "day" if dated else None, None if dated else "2024-02-29")

    first, second = ensure_star(spark, path, build), ensure_star(spark, path, build)
    assert built == [1]
    assert first.fact.count() == second.fact.count() == 12
    assert second.dim_date.count() == (1 if dated else 9497)


def test_declared_schemas_are_those_written(spark, star, tmp_path):
    path = str(tmp_path / "star")
    save_star(star, path)
    for (name, schema), loaded in zip(STAR_SCHEMAS.items(), load_star(spark, path)):
        assert loaded.dtypes == spark.read.parquet(f"{path}/{name}").dtypes, name


def test_unfinished_output_is_built_again(spark, star, tmp_path):
    path = str(tmp_path / "star")
    save_star(star, path)  # without the mark of a finished star
    built = []
    ensure_star(spark, path, lambda: built.append(1) or star)
    assert built == [1] and load_star(spark, path).dim_user.count() == 5


def test_stored_fact_keeps_users_together(spark, star, tmp_path):
    path = str(tmp_path / "star")
    save_star(star, path)
    fact = load_star(spark, path).fact.withColumn("file", F.input_file_name())
    assert fact.groupBy("User_SK").agg(F.countDistinct("file").alias("n")).filter("n > 1").isEmpty()


@pytest.mark.parametrize("day", ["2024-02-29", "2031-05-05", "1999-12-31", None])
def test_calendar_covers_the_load_date(users, titles, ratings, day):
    made = build_star(users, titles, ratings, load_date=day)
    assert made.fact.filter("Date_SK IS NULL").isEmpty()
    assert made.fact.join(made.dim_date, "Date_SK", "left_anti").isEmpty()
    if day:
        assert [r[0] for r in made.fact.select("Date_SK").distinct().collect()] == [int(day.replace("-", ""))]


def test_ratings_are_dealt_to_users_by_the_join_itself(spark, star, ratings, tmp_path):
    ratings.write.parquet(str(tmp_path / "ratings"))
    stored = spark.read.parquet(str(tmp_path / "ratings"))
    fact = ratings_fact(stored, star.dim_user, star.dim_anime, star.dim_date, load_date="2024-02-29")
    save_star(star._replace(fact=fact), str(tmp_path / "star"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [User_ID" in plan and "rebalance" not in plan.lower()
    files = load_star(spark, str(tmp_path / "star")).fact.withColumn("file", F.input_file_name())
    assert files.count() == 12
    assert files.groupBy("User_SK").agg(F.countDistinct("file").alias("n")).filter("n > 1").isEmpty()


def test_a_large_user_is_split_into_files(spark, users, titles, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FACT_ROWS_PER_FILE", 100)
    many = spark.range(1000).select(F.lit(30).alias("user_id"), F.lit(7).alias("anime_id"), (F.col("id") % 10).alias("rating"))
    save_star(build_star(users, titles, many, load_date="2024-02-29"), str(tmp_path / "star"))
    fact = load_star(spark, str(tmp_path / "star")).fact
    sizes = [r["count"] for r in fact.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 100
