from __future__ import annotations

from statistics import stdev

import pytest
from pyspark.sql import functions as F

from ratelens.functions.vocabulary import COMPACT_VOCABULARY, GENRES, BehaviourVocabulary
from ratelens.operators import behaviour, encoding, scaling, statistics
from ratelens.plans import features


@pytest.fixture(scope="module")
def rating_users(users):
    return users.withColumnRenamed("Mal ID", "user_id")


def test_substring_and_exact_list_indicators(spark):
    df = spark.createDataFrame([(1, "Musical, Drama"), (2, "Music"), (3, None)], "id int, g string")
    got = lambda mode: [
        tuple(r) for r in df.select(*encoding.list_indicators(F.col("g"), ["Music", "Drama"], "x", mode)).collect()
    ]
    assert got("substring") == [(1, 1), (1, 0), (0, 0)]
    assert got("exact") == [(0, 1), (1, 0), (0, 0)]


def test_ignoring_case(spark):
    df = spark.createDataFrame([("ACTION",)], "g string")
    assert df.select(*encoding.list_indicators(F.col("g"), ["Action"], "x", ignore_case=True)).first()[0] == 1
    assert df.select(*encoding.list_indicators(F.col("g"), ["Action"], "x")).first()[0] == 0


def test_category_indicators_sum_to_at_most_one(titles):
    flags = encoding.category_indicators(F.col("Type"), ["TV", "Movie"], "type")
    got = [tuple(r) for r in titles.orderBy("anime_id").select(*flags).collect()]
    assert got == [(0, 1), (0, 0), (1, 0), (0, 1), (1, 0), (0, 0)]


def test_scaling_handles_zero_minimum_constants_and_nulls(spark):
    df = spark.createDataFrame([(0, 5.0, 1), (10, 5.0, None), (5, None, 3)], "a int, b double, c int")
    fit = scaling.fit_columns(df, medians=["c"], bounds=["a", "b"])
    scaled = scaling.scale(scaling.impute(df, ["c"], fit), ["a", "b"], ["an", "bn"], fit)
    got = {r.a: (r.an, r.bn, r.c) for r in scaled.collect()}
    assert got == {0: (0.0, 0.0, 1), 10: (1.0, 0.0, 1), 5: (0.5, None, 3)}


def test_a_fit_can_be_stored_and_applied_to_other_rows(spark, tmp_path):
    train = spark.createDataFrame([(0.0,), (4.0,)], "a double")
    scaling.fit_columns(train, bounds=["a"]).write.parquet(str(tmp_path / "fit"))
    other = spark.createDataFrame([(2.0,), (8.0,)], "a double")
    got = scaling.scale(other, ["a"], ["n"], spark.read.parquet(str(tmp_path / "fit")))
    assert [r.n for r in got.orderBy("a").collect()] == [0.5, 2.0]


def test_regression_table_has_79_features(titles):
    table = features.regression_features(titles)
    names = features.feature_columns(table, features.REGRESSION_IDS)
    assert len(names) == 79
    got = {r.Name: r for r in table.collect()}
    assert "Beta" not in got and len(got) == 5  # no score
    assert (got["Gamma"].duration_minutes, got["Gamma"].release_year) == (90, 1999)
    assert got["Alpha"].genre_action == 1 and got["Alpha"].type_movie == 1 and got["Alpha"].studio_bones == 1
    assert got["Delta"].duration_minutes == 24  # the median of 24, 24, 90
    assert got["Gamma"].members_normalized == 1.0 and got["Alpha"].members_normalized == 0.0


def test_fit_rows_restrict_the_fit(titles):
    table = features.regression_features(titles, fit_rows=titles.filter("anime_id IN (7, 3)"))
    assert table.filter("Name = 'Gamma'").first().popularity_normalized == 0.0
    assert table.filter("Name = 'Delta'").first().popularity_normalized > 1.0


def joined_form(ratings, titles, genre, kind):
    """One join per feature, as a second way to the same numbers."""
    rated = ratings.join(titles.select("anime_id", "Genres", "Type"), "anime_id", "left")
    base = rated.groupBy("user_id").agg(F.count("*").alias("n"))
    counted = rated.filter(F.col("Genres").contains(genre)).groupBy("user_id").agg(F.count("*").alias("g"))
    average = rated.filter(F.col("Type") == kind).groupBy("user_id").agg(F.avg("rating").alias("a"))
    joined = base.join(counted, "user_id", "left").join(average, "user_id", "left").fillna(0, ["g"])
    return {r.user_id: (r.n, r.g, r.a) for r in joined.collect()}


def test_single_aggregation_equals_the_joined_form(ratings, titles):
    table = behaviour.user_behaviour(ratings, titles)
    got = {r.user_id: (r.total_ratings, r.genre_count_drama, r.avg_rating_movie) for r in table.collect()}
    assert got == joined_form(ratings, titles, "Drama", "Movie")


def test_behaviour_reads_ratings_once(spark, ratings, titles, tmp_path):
    ratings.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    plan = behaviour.user_behaviour(stored, titles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_repeated_titles_and_single_ratings(spark, titles):
    ratings = spark.createDataFrame([(1, 7, 8), (1, 7, 10), (2, 999, 3)], "user_id int, anime_id int, rating int")
    got = {r.user_id: r for r in behaviour.user_behaviour(ratings, titles, COMPACT_VOCABULARY).collect()}
    assert (got[1].total_ratings, got[1].unique_anime_count, got[1].genre_count_sci_fi) == (2, 1, 2)
    assert got[2].rating_std is None and got[2].genre_count_sci_fi == 0 and got[2].avg_rating_tv is None
    assert "genre_count_isekai" not in got[1].asDict()


def test_classification_table(ratings, rating_users, titles):
    selection = features.UserSelection(min_ratings=3)
    table = features.classification_features(ratings, rating_users, titles, selection)
    got = {r.user_id: r for r in table.collect()}
    assert set(got) == {10, 30, 50}  # 20 has no gender, 41 two ratings
    assert got[10].gender_encoded == 1 and got[30].gender_encoded == 0
    assert got[10].genre_diversity == 4 and got[10].genre_pct_action == 0.5
    assert got[10].drop_rate == 0.0 and got[30].drop_rate == 0.2
    assert got[10].preference_intensity == 1.0
    assert got[30].rating_consistency == pytest.approx(stdev([10, 1, 8, 9]) / 7)
    values = [v for r in got.values() for n, v in r.asDict().items() if n.endswith("_normalized")]
    assert min(values) == 0.0 and max(values) == 1.0
    assert not any(v is None for r in got.values() for v in r)
    assert table.columns == [*features.CLASSIFICATION_IDS, *features.classification_columns()]


def test_missing_profile_columns_become_zero(spark):
    users = spark.createDataFrame([(1, "Male", 3.5)], "user_id int, Gender string, `Mean Score` double")
    row = behaviour.user_profile(users).first()
    assert row.user_mean_score == 3.5 and row.user_dropped == 0.0


def test_vocabularies():
    assert len(GENRES) == 30 and len(COMPACT_VOCABULARY.genres) == 23 and len(COMPACT_VOCABULARY.types) == 5
    assert BehaviourVocabulary(("A",), ("B",)).ignore_case is False


def test_correlation_distribution_and_class_means(spark):
    df = spark.createDataFrame(
        [(1.0, 2, 7, "a"), (2.0, 4, 7, "a"), (3.0, 6, 7, "b"), (None, 1, 7, "b")], "y double, x int, c int, k string"
    )
    corr = {r.feature: r.correlation for r in statistics.feature_target_correlation(df, ["x", "c"], "y").collect()}
    assert corr["x"] == pytest.approx(1.0) and corr["c"] is None
    row = statistics.target_distribution(df, "y").first()
    assert (row["count"], row["mean"], row["median"], row["value_range"]) == (3, 2.0, 2.0, 2.0)
    assert row["skewness"] == pytest.approx(0.0)
    means = {r.feature: r for r in statistics.class_feature_means(df, ["x", "c"], "k", "a", "b").collect()}
    assert (means["x"].mean_first, means["x"].mean_second) == (3.0, 3.5) and means["c"].ratio == 1.0


def test_collapse_titles(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "id int, name string")
    got = statistics.collapse_titles(df, "id", ["name"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "A", 2), (2, "B", 1)]


def test_user_features_combine_before_every_shuffle(spark, ratings, titles):
    """One scan of the ratings, and a partial aggregate below each exchange on users: no hot user in one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = behaviour.user_behaviour(ratings, titles)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [line.lstrip(" :+-") for line in plan.split("\n")]
    by_user = [k for k, line in enumerate(lines) if line.startswith("Exchange hashpartitioning(user_id")]
    assert len(by_user) == 2 and all("partial_" in lines[k + 1] for k in by_user)


def test_medians_are_exact_beyond_a_sketch(spark):
    """300,000 values: a sketch may be 30 ranks off, which the tenth fraction shows for some column."""
    columns = {f"c{k}": F.expr(f"pmod(xxhash64(id, {k}), 100000000)") for k in range(10)}
    rows = spark.range(300_000).withColumns(columns).drop("id")
    fit = scaling.fit_columns(rows, medians=list(columns)).first()["fit"]
    table = rows.toPandas()
    for name in columns:
        exact = int(table[name].sort_values().iloc[149_999])
        assert fit[f"median {name}"] == exact and isinstance(fit[f"median {name}"], int)
    distribution = statistics.target_distribution(rows, "c3").first()
    assert distribution["median"] == int(table["c3"].sort_values().iloc[149_999])


def test_titles_are_merged_and_tasks_bounded(spark, titles, monkeypatch):
    """Neither all titles' indicators are sent to the executors, nor do tasks hold more rows as the input grows."""
    ratings = spark.range(3000).selectExpr("id % 50 AS user_id", "id % 7 AS anime_id", "cast(id % 10 + 1 as int) AS rating")
    whole = behaviour.user_behaviour(ratings, titles)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    monkeypatch.setattr(behaviour, "ROWS_PER_TASK", 100)
    split = behaviour.user_behaviour(ratings, titles)
    assert "REPARTITION_BY_NUM" in (plan := split._jdf.queryExecution().executedPlan().toString()) and ", 32)" in plan
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
