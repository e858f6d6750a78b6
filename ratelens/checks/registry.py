"""Every operator as a query over the retail tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.casting import to_known_whole
from ratelens.functions.rules import valid_age_rating, valid_studio
from ratelens.functions.text import duration_minutes, year_in_text
from ratelens.functions.vocabulary import AGE_RATINGS, COMPACT_VOCABULARY, GENRES, SOURCES, STUDIOS, TYPES
from ratelens.operators import behaviour, bootstrap, encoding, profiling, quantiles, sampling, scaling, star, statistics, trees
from ratelens.plans import features as feature_plans
from ratelens.plans import training
from ratelens.plans.business import QUERIES, quintile_cut_errors, with_totals
from ratelens.plans.runner import BATCHES, run_batch
from ratelens.session import scratch_path, stored
from ratelens.sources import ingest, readers, writers
from ratelens.sources.retail import raw_ratings, raw_titles, raw_users, retail_star, stored_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the business queries that differ from the defaults, to fit the retail tables.
PARAMETERS = {
    "users_never_low": {"low_max": 1},
    "users_never_low_anti": {"low_max": 1},
    "critic_ratings_of_user": {"username": "Customer#000000007"},
    "recent_users_in_location": {"joined_after": "1995-06-01"},
    "perfect_raters_of_title": {"title": "hot ring"},
}
SCALED = ("Members", "Favorites", "Popularity", "Watching", "Completed")
LOAD_DATE = "2026-02-03"  # after the default calendar
USER_SAMPLE = 500
CLASS_FEATURES = tuple(feature_plans.classification_columns())
TREES = 3  # of which the first levels are checked
MIN_RATINGS = 10
REPLICATES = 100
AT_ONCE = 4
QUANTILE_COLUMNS = ("user_id", "anime_id", "rating")
QUANTILE_FRACTIONS = (0.01, 0.25, 0.5, 0.75, 0.99)


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because their sums depend on the order of addition, and dates as ISO text."""
    shown = {
        "double": lambda c: F.round(c, digits),
        "date": lambda c: c.cast("string"),
    }
    return df.select(
        *[shown.get(kind, lambda c: c)(F.col(f"`{name}`")).alias(name) for name, kind in df.dtypes]
    )


def _users(spark: SparkSession, directory: str) -> DataFrame:
    return raw_users(spark, directory).withColumnRenamed("Mal ID", "user_id")


def _business(name: str) -> Query:
    return lambda spark, directory: comparable(QUERIES[name](retail_star(spark, directory), **PARAMETERS.get(name, {})))


def _star_table(name: str) -> Query:
    return lambda spark, directory: comparable(getattr(retail_star(spark, directory), name))


def dim_user(spark, directory):
    """The user dimension alone: it needs neither titles nor the fact."""
    path = stored_path(spark, directory, "dim_user")
    return comparable(writers.materialize(spark, path, lambda: star.user_dimension(raw_users(spark, directory))))


def _title_text(spark: SparkSession, directory: str) -> DataFrame:
    return raw_titles(spark, directory).select("anime_id", "Duration", "Aired", "Episodes")


def csv_roundtrip(spark, directory):
    path = scratch_path(spark, "titles-csv")
    writers.write_csv(raw_titles(spark, directory).select("anime_id", "Name", "Genres", "Score", "Members"), path)
    kinds = {"anime_id": "bigint", "Score": "double", "Members": "int"}
    return readers.read_csv(spark, path, kinds, multi_line=False)


def parquet_roundtrip(spark, directory):
    path = scratch_path(spark, "ratings")
    writers.write_dataset(raw_ratings(spark, directory), f"{path}/ratings", "parquet")
    return comparable(readers.load_split(spark, path, "ratings"))


def csv_quoted_roundtrip(spark, directory):
    """Texts with commas, quotes and line breaks, and whether a row had as many fields as the header."""
    path = scratch_path(spark, "quoted-csv")
    told = F.concat("Name", F.lit('\nsaid "'), "Genres", F.lit('", twice'))
    texts = ("Name", "Type", "Source", "Genres", "Studios", "Producers", "Aired", "Duration")
    writers.write_csv(raw_titles(spark, directory).select("anime_id", *texts, told.alias("Synopsis")), path)
    read = readers.read_csv(spark, path, {"anime_id": "bigint"}, corrupt_column="__corrupt")
    return read.withColumn("well_formed", F.col("__corrupt").isNull()).drop("__corrupt")


def csv_split(spark, directory):
    """A split for which only the CSV is there."""
    path = scratch_path(spark, "csv-split")
    writers.write_dataset(raw_ratings(spark, directory), f"{path}/ratings", "csv")
    kinds = {"user_id": "bigint", "anime_id": "bigint", "rating": "int", "rated_on": "date"}
    return comparable(readers.load_split(spark, path, "ratings", kinds))


def fact_undated(spark, directory):
    """Ratings without a date have the key of the load date, and the calendar has that day."""
    built = star.build_star(
        raw_users(spark, directory),
        raw_titles(spark, directory),
        raw_ratings(spark, directory).drop("rated_on"),
        load_date=LOAD_DATE,
    )
    return comparable(built.fact.join(built.dim_date.select("Date_SK", "Full_Date"), "Date_SK"))


def category_rules(spark, directory):
    """Titles' age ratings and studios, some replaced by texts that one condition of a rule alone rejects."""
    key = F.col("anime_id")
    age = (
        F.when(key % 8 == 1, "7.5").when(key % 8 == 2, "https://a.example/").when(key % 8 == 3, "R - 17+ 24 min")
        .when(key % 8 == 4, F.concat(F.lit("G - All Ages"), F.repeat(F.lit("x"), F.lit(60))))
        .when(key % 8 == 5, "spring 1999").when(key % 8 == 6, "Madhouse").otherwise(F.col("Rating"))
    )
    long = lambda n: F.concat(F.repeat(F.lit("a"), F.lit(n)), F.lit(","), F.repeat(F.lit("b"), F.lit(n)))
    studio = (
        F.when(key % 5 == 1, F.concat(F.lit("https://s.example/"), key.cast("string")))
        .when(key % 5 == 2, F.repeat(F.lit("a"), F.lit(120))).when(key % 5 == 3, long(60))
        .when(key % 5 == 4, long(80)).otherwise(F.col("Studios"))
    )
    return raw_titles(spark, directory).select(
        "anime_id", valid_age_rating(age).alias("age_rating_valid"), valid_studio(studio).alias("studio_valid")
    )


def _ratings_as_predictions(spark, directory):
    """Each rating taken as a prediction of its title's score."""
    scored = feature_plans.extract_numbers(raw_titles(spark, directory)).select("anime_id", "Score")
    rated = raw_ratings(spark, directory).join(scored, "anime_id")
    return rated.select("user_id", "anime_id", "Score", F.col("rating").cast("double").alias("prediction"))


def _classes_by_rule(spark, directory):
    """Users of a known class; those with 5,000 completed titles and more are predicted as class 1."""
    known = _users(spark, directory).filter(F.col("Gender").isin("Male", "Female"))
    return known.select(
        "user_id",
        F.when(F.col("Gender") == "Female", 1).otherwise(0).alias("gender_encoded"),
        F.when(F.col("Completed") >= 5000, 1.0).otherwise(0.0).alias("prediction"),
    )


def batch_status(spark, directory):
    """All batches of queries, several queries at once, with the rows that each has written."""
    results = with_totals(retail_star(spark, directory))
    tables = []
    for batch in BATCHES:
        path = scratch_path(spark, batch)
        status = run_batch(spark, results, batch, path, formats="parquet", parameters=PARAMETERS, at_once=AT_ONCE)
        tables.append(status.select(F.lit(batch).alias("batch"), "query", "status", "row_count"))
    return functools.reduce(DataFrame.unionByName, tables)


def written_dataset_info(spark, directory):
    """The column profile as the writer leaves it."""
    path = scratch_path(spark, "info")
    profile = writers.write_dataset_info(retail_star(spark, directory).dim_user, path)
    return comparable(spark.read.schema(profile.schema).json(f"{path}/dataset_info.json"))


def written_statistics(spark, directory):
    """The fact's statistics as the writer leaves them as CSV."""
    path = scratch_path(spark, "statistics")
    known = writers.write_numeric_statistics(retail_star(spark, directory).fact, path)
    kinds = dict(known.dtypes)
    return comparable(readers.read_csv(spark, f"{path}/numeric_statistics.csv", kinds, multi_line=False))


def written_assessment(spark, directory):
    """The titles' assessment as the writer leaves it."""
    path = scratch_path(spark, "assessment")
    titles = retail_star(spark, directory).dim_anime
    writers.write_numeric_statistics(titles, path)
    schema = profiling.assess_numeric(profiling.numeric_statistics(titles)).schema
    return comparable(spark.read.schema(schema).json(f"{path}/numeric_assessment.json"))


def ratings_renamed(spark, directory):
    """Ratings whose columns have names of other data sets."""
    names = {"user_id": "USERID", "anime_id": "Item", "rating": "Score"}
    other = {"user_id": ["userid"], "anime_id": ["item", "title_id"], "rating": ["score"]}
    return comparable(readers.with_standard_names(raw_ratings(spark, directory).withColumnsRenamed(names), other))


def known_users(spark, directory):
    women = _users(spark, directory).filter(F.col("Gender") == "Female")
    return comparable(readers.ratings_of_known_users(raw_ratings(spark, directory), women))


def left_titles(spark, directory):
    typed = raw_titles(spark, directory).filter(F.col("Type").isNotNull()).select("anime_id", "Type", "Genres")
    return comparable(behaviour.ratings_with_titles(raw_ratings(spark, directory), typed))


def category_onehot(spark, directory):
    titles = raw_titles(spark, directory)
    return titles.select(
        "anime_id",
        *encoding.category_indicators(F.col("Type"), TYPES, "type"),
        *encoding.category_indicators(F.col("Source"), SOURCES, "source"),
        *encoding.category_indicators(F.col("Rating"), AGE_RATINGS, "rating"),
    )


def _list_query(column: str, labels, prefix: str, mode: str) -> Query:
    return lambda spark, directory: raw_titles(spark, directory).select(
        "anime_id", *encoding.list_indicators(F.col(column), labels, prefix, mode)
    )


def median_impute(spark, directory):
    numbers = feature_plans.extract_numbers(raw_titles(spark, directory))
    columns = feature_plans.IMPUTED_COLUMNS
    filled = scaling.impute(numbers, columns, scaling.fit_columns(numbers, medians=columns))
    return filled.select("anime_id", *[F.col(f"`{c}`") for c in columns])


def exact_quantiles(spark, directory):
    return quantiles.exact_quantiles(raw_ratings(spark, directory), QUANTILE_COLUMNS, QUANTILE_FRACTIONS)


def minmax_scale(spark, directory):
    titles = raw_titles(spark, directory).select("anime_id", *SCALED)
    outputs = [f"{c.lower()}_normalized" for c in SCALED]
    scaled = scaling.scale(titles, SCALED, outputs, scaling.fit_columns(titles, bounds=SCALED))
    return comparable(scaled.select("anime_id", *outputs))


def regression_features(spark, directory):
    return feature_plans.regression_features(raw_titles(spark, directory))


def user_features(spark, directory):
    return behaviour.user_behaviour(raw_ratings(spark, directory), raw_titles(spark, directory))


def user_features_compact(spark, directory):
    return behaviour.user_behaviour(raw_ratings(spark, directory), raw_titles(spark, directory), COMPACT_VOCABULARY)


def classification_features(spark, directory):
    return feature_plans.classification_features(
        raw_ratings(spark, directory),
        _users(spark, directory),
        raw_titles(spark, directory),
        feature_plans.UserSelection(min_ratings=MIN_RATINGS),
    )


def user_sample(spark, directory):
    return sampling.seeded_sample(_users(spark, directory), USER_SAMPLE, "user_id").select("user_id", "Gender")


def split_random(spark, directory):
    return sampling.random_split(_users(spark, directory).select("user_id", "Gender"), "user_id")


def split_stratified(spark, directory):
    known = _users(spark, directory).select("user_id", "Gender").filter(F.col("Gender").isNotNull())
    return sampling.stratified_split(known, "user_id", "Gender")


def class_feature_means(spark, directory):
    table = classification_features(spark, directory)
    return statistics.class_feature_means(table, CLASS_FEATURES, "Gender", "Male", "Female")


def feature_target_corr(spark, directory):
    table = regression_features(spark, directory)
    names = feature_plans.feature_columns(table, feature_plans.REGRESSION_IDS)
    return statistics.feature_target_correlation(table, names, "Score")


def title_collapse(spark, directory):
    titles = raw_titles(spark, directory).select("anime_id", "Name", "Type", "Score")
    rated = raw_ratings(spark, directory).join(titles, "anime_id")
    return statistics.collapse_titles(rated, "anime_id", ["Name", "Type", "Score"])


def _trained_regression(spark, directory):
    titles = sampling.random_split(raw_titles(spark, directory), "anime_id")
    fitted = feature_plans.fit_titles(titles.filter(F.col("split") == "train"))
    table = feature_plans.regression_features(titles, fitted=fitted)
    saved = writers.materialize(
        spark, scratch_path(spark, "regression"), lambda: sampling.random_split(table, "anime_id").fillna(0)
    )
    train, test = (saved.filter(F.col("split") == s) for s in ("train", "test"))
    names = feature_plans.feature_columns(saved, (*feature_plans.REGRESSION_IDS, "split"))
    return training.rank_regressors(
        train, test, names, models_path=stored_path(spark, directory, "models"), key=["anime_id"], leave_out=False
    )


def _split_users(spark, directory):
    return feature_plans.split_classification_features(
        raw_ratings(spark, directory),
        _users(spark, directory),
        raw_titles(spark, directory),
        feature_plans.UserSelection(min_ratings=MIN_RATINGS),
    )[0]


def classification_scaled_train_fit(spark, directory):
    """Scaled columns and split of every user, by the bounds of the train part."""
    scaled = [f"{c}_normalized" for c in behaviour.SCALED_COLUMNS]
    return comparable(_split_users(spark, directory).select("user_id", "Gender", "split", *scaled))


def extra_tree_levels(spark, directory):
    """The first two levels of some extremely randomised trees over all titles: each node's bounds, cut and gain."""
    table = regression_features(spark, directory).fillna(0)
    names = feature_plans.feature_columns(table, feature_plans.REGRESSION_IDS)
    x = F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("x")
    rows = trees.place(table.select(x, trees.in_units(F.col("Score")).alias("y")), TREES)
    first = stored(trees.best_splits(rows, 42), "level")
    both = first.union(trees.best_splits(trees.children(rows, first), 42))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature") + 1).alias("feature")
    return both.select("tree", "node", named, "cut", "low", "high", "n", "n_left", "gain")


def csv_quarantine(spark, directory):
    """Titles written as CSV lines of which some have a field too few, one too many, or a word for a number."""
    path = scratch_path(spark, "damaged")
    key, name = F.col("anime_id"), F.concat(F.lit('"'), F.replace("Name", F.lit('"'), F.lit('""')), F.lit(', ""so""",'))
    members = F.when(key % 11 == 3, "many").otherwise(F.coalesce(F.col("Members").cast("string"), F.lit("")))
    end = F.when(key % 11 == 1, "").when(key % 11 == 2, ",x,y").otherwise(",x")
    lines = raw_titles(spark, directory).select(F.concat(key.cast("string"), F.lit(","), name, members, end).alias("value"))
    header = spark.range(1).select(F.lit("anime_id,Name,Members,Last").alias("value"))
    # Each file begins with the header, as files of a CSV folder do.
    parts = lines.withColumn("file", F.pmod(F.xxhash64("value"), F.lit(4)).cast("int"))
    heads = header.select("value", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("file"))
    both = heads.withColumn("rank", F.lit(0)).union(parts.select("value", "file", F.lit(1)))
    both.repartition(4, "file").sortWithinPartitions("file", "rank").drop("rank").write.partitionBy("file").text(path)
    kinds = {"anime_id": "bigint", "Members": "int"}
    tables = []
    for part in range(4):
        rows = ingest.ingest_csv(spark, f"{path}/file={part}", f"{path}-typed/{part}", kinds, multi_line=False)
        kept = rows.select("anime_id", "Name", "Members", "Last", F.lit("kept").alias("fault"), F.lit(None).cast("string").alias("record"))
        faults = ingest.quarantine(spark, f"{path}-typed/{part}")
        none = [F.lit(None).cast(kind).alias(n) for n, kind in rows.dtypes]
        tables += [kept, faults.select(*none, F.col(ingest.FAULT).alias("fault"), F.col(ingest.RECORD).alias("record"))]
    return functools.reduce(DataFrame.unionByName, tables)


def _trained_classification(spark, directory):
    table = _split_users(spark, directory)
    saved = writers.materialize(spark, scratch_path(spark, "classification"), lambda: table)
    train, test = (saved.filter(F.col("split") == s) for s in ("train", "test"))
    names = feature_plans.feature_columns(saved, (*feature_plans.CLASSIFICATION_IDS, "split"))
    return training.rank_classifiers(
        train, test, names, models_path=stored_path(spark, directory, "models"), key=["user_id"], leave_out=False
    )


def classification_report(spark, directory):
    ranking = _trained_classification(spark, directory)
    return training.classification_report(
        ranking.predictions[ranking.best], "gender_encoded", {0: "Male", 1: "Female"}
    )


def registered() -> dict[str, Query]:
    """All queries by key."""
    tables_of_star = {
        "dim_user": dim_user,
        "dim_item": _star_table("dim_anime"),
        "dim_date": _star_table("dim_date"),
        "fact_rating": _star_table("fact"),
        "fact_undated": fact_undated,
        "quintile_cut_errors": lambda s, d: quintile_cut_errors(retail_star(s, d)),
    }
    profiles = {
        "dataset_info": lambda s, d: profiling.dataset_info(retail_star(s, d).dim_anime),
        "dataset_description": lambda s, d: comparable(profiling.describe_dataset(retail_star(s, d).dim_user)),
        "dataset_sample": lambda s, d: comparable(profiling.sample_rows(retail_star(s, d).dim_user, [F.asc("User_SK")])),
        "numeric_stats": lambda s, d: comparable(profiling.numeric_statistics(retail_star(s, d).fact)),
        "numeric_assessment": lambda s, d: comparable(
            profiling.assess_numeric(profiling.numeric_statistics(retail_star(s, d).dim_anime))
        ),
        "quality_report": lambda s, d: comparable(
            profiling.quality_report(left_titles(s, d))
        ),
    }
    profiles |= {
        "written_dataset_info": written_dataset_info,
        "written_statistics": written_statistics,
        "written_assessment": written_assessment,
        "batch_status": batch_status,
    }
    sources = {
        "csv_roundtrip": csv_roundtrip,
        "parquet_roundtrip": parquet_roundtrip,
        "csv_quoted_roundtrip": csv_quoted_roundtrip,
        "csv_split": csv_split,
        "csv_quarantine": csv_quarantine,
        "ratings_renamed": ratings_renamed,
        "ratings_of_known_users": known_users,
        "ratings_left_items": left_titles,
    }
    encodings = {
        "genre_indicators": _list_query("Genres", GENRES, "genre", "substring"),
        "genre_indicators_exact": _list_query("Genres", GENRES, "genre", "exact"),
        "studio_indicators": _list_query("Studios", STUDIOS, "studio", "substring"),
        "category_onehot": category_onehot,
        "duration_minutes": lambda s, d: _title_text(s, d).select(
            "anime_id", duration_minutes(F.col("Duration")).alias("duration_minutes")
        ),
        "release_year": lambda s, d: _title_text(s, d).select(
            "anime_id",
            year_in_text(F.col("Aired"), "last").alias("last_year"),
            year_in_text(F.col("Aired"), "first").alias("first_year"),
        ),
        "category_rules": category_rules,
        "episodes_clean": lambda s, d: _title_text(s, d).select(
            "anime_id", to_known_whole(F.col("Episodes")).alias("episodes_clean")
        ),
        "median_impute": median_impute,
        "exact_quantiles": exact_quantiles,
        "minmax_scale": minmax_scale,
    }
    tables = {
        "regression_features": lambda s, d: comparable(regression_features(s, d)),
        "user_features": lambda s, d: comparable(user_features(s, d)),
        "user_features_compact": lambda s, d: comparable(user_features_compact(s, d)),
        "user_features_derived": lambda s, d: comparable(classification_features(s, d)),
        "classification_scaled_train_fit": classification_scaled_train_fit,
        "extra_tree_levels": extra_tree_levels,
        "user_sample": user_sample,
        "split_random": split_random,
        "split_stratified": split_stratified,
        "split_report": lambda s, d: comparable(sampling.split_report(split_random(s, d))),
        "class_balance": lambda s, d: sampling.class_balance(split_stratified(s, d), "Gender", "split"),
        "feature_target_corr": lambda s, d: comparable(feature_target_corr(s, d)),
        "target_distribution": lambda s, d: comparable(
            statistics.target_distribution(feature_plans.extract_numbers(raw_titles(s, d)), "Score")
        ),
        "class_feature_means": lambda s, d: comparable(class_feature_means(s, d), 5),
        "title_collapse": title_collapse,
    }
    models = {
        # Time and status depend on the run, not on the tables.
        "regression_leaderboard": lambda s, d: _trained_regression(s, d).leaderboard.drop("seconds", "status"),
        "classification_leaderboard": lambda s, d: _trained_classification(s, d).leaderboard.drop("seconds", "status"),
        "classification_report": classification_report,
    }
    metrics = {
        "regression_metrics": lambda s, d: comparable(
            training.regression_metrics(_ratings_as_predictions(s, d), "Score")
        ),
        "regression_intervals": lambda s, d: comparable(
            bootstrap.regression_intervals(_ratings_as_predictions(s, d), "Score", ["user_id", "anime_id"], REPLICATES)
        ),
        "classification_intervals": lambda s, d: comparable(
            bootstrap.classification_intervals(_classes_by_rule(s, d), "gender_encoded", ["user_id"], REPLICATES)
        ),
        "class_confusion": lambda s, d: training.confusion(_classes_by_rule(s, d), "gender_encoded"),
        "classification_metrics": lambda s, d: comparable(
            training.classification_metrics(_classes_by_rule(s, d), "gender_encoded")
        ),
        "class_report_by_rule": lambda s, d: comparable(
            training.classification_report(_classes_by_rule(s, d), "gender_encoded", {0: "Male", 1: "Female"})
        ),
    }
    business = {name: _business(name) for name in QUERIES}
    return {**tables_of_star, **business, **sources, **profiles, **encodings, **tables, **metrics, **models}
