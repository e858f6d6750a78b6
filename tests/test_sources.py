from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ratelens.session import build_session, scratch_root
from ratelens.sources import readers, writers


@pytest.fixture()
def messy(tmp_path):
    path = tmp_path / "messy.csv"
    path.write_text(
        'id,Name,Score\n1,"Comma, and ""quote""",7.5\n2,"Line\nbreak",UNKNOWN\n3,Short\n4,Long,1,9\n5.0,Plain,\n',
        encoding="utf-8",
    )
    return str(path)


def test_csv_is_typed_by_name(spark, messy):
    got = readers.read_csv(spark, messy, {"id": "int", "Score": "double"}, corrupt_column="_corrupt").orderBy("id")
    rows = [(r.id, r.Name, r.Score) for r in got.collect()]
    assert rows == [
        (1, 'Comma, and "quote"', 7.5), (2, "Line\nbreak", None), (3, "Short", None), (4, "Long", 1.0), (5, "Plain", None)
    ]
    assert [r.id for r in got.collect() if r._corrupt] == [3, 4]


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    writers.write_csv(spark.range(0, 1000, 1, 3), str(tmp_path / "out"))
    got = readers.read_csv(spark, str(tmp_path / "out"), {"id": "bigint"}, multi_line=False)
    assert got.agg(F.sum("id")).first()[0] == 499500


def test_quotes_survive_a_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 1), (None, 2)], "t string, n int")
    writers.write_csv(df, str(tmp_path / "q"), single_file=True)
    assert readers.read_csv(spark, str(tmp_path / "q"), {"n": "int"}).exceptAll(df).isEmpty()


def test_missing_inputs_are_listed(spark, messy, tmp_path):
    readers.require_inputs(spark, [messy])
    with pytest.raises(FileNotFoundError, match="one.csv, .*two.csv"):
        readers.require_inputs(spark, [messy, str(tmp_path / "one.csv"), str(tmp_path / "two.csv")])


def test_columns_are_found_by_alias(spark):
    df = spark.createDataFrame([(1, 2)], "`UID` int, other int")
    assert readers.with_standard_names(df, {"user_id": ["uid"]}).columns == ["user_id", "other"]
    both = spark.createDataFrame([(1, 2)], "`uid` int, `User_ID` int")
    assert readers.with_standard_names(both, {"user_id": ["uid"]}).columns == ["uid", "user_id"]


def test_missing_and_ambiguous_columns_are_reported_together(spark):
    df = spark.createDataFrame([(1, 2)], "id int, other int")
    with pytest.raises(ValueError, match="Gender: no column.*id: taken for user_id and anime_id"):
        readers.with_standard_names(df, {"user_id": ["id"], "anime_id": ["id"], "Gender": []})


def test_split_prefers_parquet_and_falls_back(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        readers.load_split(spark, base, "train")
    writers.write_dataset(spark.range(3), f"{base}/train", "csv")
    assert readers.load_split(spark, base, "train").dtypes == [("id", "string")]
    writers.write_dataset(spark.range(5), f"{base}/train", "parquet")
    assert readers.load_split(spark, base, "train").count() == 5
    assert readers.load_split(spark, base, "train", {"id": "bigint"}, prefer_parquet=False).count() == 3


def test_dataset_formats(spark, tmp_path):
    writers.write_dataset(spark.range(4), str(tmp_path / "both"))
    assert readers.path_exists(spark, str(tmp_path / "both.csv"))
    assert readers.path_exists(spark, str(tmp_path / "both.parquet"))
    with pytest.raises(ValueError):
        writers.write_dataset(spark.range(4), str(tmp_path / "x"), "orc")


def test_ratings_of_known_users(spark):
    ratings = spark.createDataFrame([(1, 5), (2, 6)], "user_id int, rating int")
    known = spark.createDataFrame([(2,), (2,)], "user_id int")
    assert [tuple(r) for r in readers.ratings_of_known_users(ratings, known).collect()] == [(2, 6)]
    with pytest.raises(ValueError):
        readers.ratings_of_known_users(ratings, known.filter("user_id = 9"))


def test_materialize_builds_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(7)

    path = str(tmp_path / "t")
    assert writers.materialize(spark, path, build).count() == 7
    assert writers.materialize(spark, path, build).count() == 7
    assert built == [1]


def test_metadata_roundtrip(spark, tmp_path):
    writers.write_metadata(spark, {"task": "x", "features": ["ü", "b"]}, str(tmp_path / "m"))
    assert writers.read_metadata(spark, str(tmp_path / "m")) == {"task": "x", "features": ["ü", "b"]}


def test_profiles_are_written(spark, titles, tmp_path):
    df = titles.select("anime_id", "Name")
    writers.write_dataset_info(df, str(tmp_path))
    writers.write_numeric_statistics(df, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/dataset_info.json").count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/numeric_statistics.csv").count() == 1
    assert spark.read.json(f"{tmp_path}/numeric_assessment.json").first().quality == "excellent"
    assert writers.write_numeric_statistics(df.select("Name"), str(tmp_path / "none")).isEmpty()


def test_scratch_lies_in_the_configured_folder(spark, tmp_path, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://nn/shared/"}.get(key, default)

    class Context:
        master, applicationId = "yarn", "app-1"

    class Session:
        conf, sparkContext = Conf(), Context()

    assert scratch_root(Session()) == "hdfs://nn/shared/ratelens/app-1"
    monkeypatch.setattr(Conf, "get", lambda self, key, default=None: default)
    with pytest.raises(RuntimeError):
        scratch_root(Session())
    assert build_session().conf.get("spark.sql.ansi.enabled") == "true"


def test_other_parameters_rebuild(spark, tmp_path):
    path, built = f"{tmp_path}/table", []

    def build():
        built.append(1)
        return spark.range(len(built))

    for parameters, rows in (({"n": [1, 2]}, 1), ({"n": [1, 2]}, 1), ({"n": [1, 3]}, 2), (None, 3)):
        assert writers.materialize(spark, path, build, parameters).count() == rows
