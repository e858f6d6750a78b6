from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ratelens.plans.preprocessing import Preprocessor, PreprocessorModel
from ratelens.sources import ingest


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, float(k) if k % 3 else None, "ab"[k % 2] if k % 5 else None, float(k * k)) for k in range(30)]
    return spark.createDataFrame(data, "id int, a double, kind string, b double")


def test_other_rows_move_nothing(rows):
    train = rows.filter("id < 20")
    stage = Preprocessor(medianCols=["a"], scaledCols=["a", "b"], categoryCols=["kind"])
    model = stage.fit(train)
    assert model.fitted == stage.fit(train.repartition(5)).fitted
    assert model.fitted["numbers"]["max b"] == 19.0**2 and model.fitted["numbers"]["median a"] == 10.0
    found = {r["id"]: r for r in model.transform(rows).collect()}
    assert found[29]["b_normalized"] == pytest.approx(29**2 / 19**2) and found[0]["a"] == 10.0
    assert (found[1]["kind_a"], found[1]["kind_b"], found[0]["kind_a"]) == (0, 1, 0)


def test_saved_and_loaded(rows, tmp_path):
    model = Preprocessor(medianCols=["a"], scaledCols=["b"], categoryCols=["kind"], maxCategories=1).fit(rows)
    model.write().save(str(tmp_path / "model"))
    loaded = PreprocessorModel.load(str(tmp_path / "model"))
    assert loaded.fitted == model.fitted and loaded.fitted["categories"]["kind"] == ["a"]
    assert loaded.transform(rows).collect() == model.transform(rows).collect()


def test_nothing_to_fit_on(rows):
    empty = Preprocessor(medianCols=["a"], scaledCols=["b"], categoryCols=["kind"]).fit(rows.limit(0))
    found = empty.transform(rows).select("a", "b_normalized")
    assert found.filter(F.col("b_normalized").isNotNull()).isEmpty() and found.count() == 30


CSV = 'id,name,n\n1,"a, ""b""\nc",5\n2,short\n3,x,6,long\n4,y,many\n5,,\n6,"q,r",7,8,9\n'


def test_rows_at_fault_are_set_aside_and_counted(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    target, kinds = str(tmp_path / "out"), {"id": "bigint", "n": "int"}
    rows = ingest.ingest_csv(spark, str(tmp_path / "in.csv"), target, kinds)
    assert sorted(map(tuple, rows.collect())) == [(1, 'a, "b"\nc', 5), (4, "y", None), (5, None, None)]
    assert ingest.ingest_counts(spark, target) == {"none": 2, "short": 1, "long": 2, "unparsable": 1}
    faults = sorted(map(tuple, ingest.quarantine(spark, target).collect()))
    assert faults == [("long", '3,x,6,long'), ("long", '6,"q,r",7,8,9'), ("short", "2,short"), ("unparsable", "4,y,many")]


def test_a_csv_is_parsed_again_only_when_it_has_changed(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id\n1\n")
    target = str(tmp_path / "out")
    read = lambda: ingest.ingest_csv(spark, str(tmp_path / "in.csv"), target, {"id": "int"}, multi_line=False)
    assert [r["id"] for r in read().collect()] == [1]
    written = {p.name for p in (tmp_path / "out").rglob("*.parquet")}
    read()
    assert {p.name for p in (tmp_path / "out").rglob("*.parquet")} == written
    (tmp_path / "in.csv").write_text("id\n2\n3\n")
    assert sorted(r["id"] for r in read().collect()) == [2, 3]
    (tmp_path / "in.csv").unlink()
    assert read().count() == 2  # the file is gone, what was made from it is not


def test_manifest(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("12345")
    one = ingest.input_manifest(spark, [str(tmp_path / "a")])
    assert (one["files"], one["bytes"]) == (1, 5) and one == ingest.input_manifest(spark, [str(tmp_path / "a")])
    (tmp_path / "a" / "x.csv").write_text("54321")
    assert ingest.input_manifest(spark, [str(tmp_path / "a")])["digest"] != one["digest"]
    assert ingest.input_manifest(spark, [str(tmp_path / "b")]) is None
