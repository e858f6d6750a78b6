from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from ratelens.functions.casting import iso_date, to_known_whole, to_whole, typed
from ratelens.functions.hashing import HASH_SPAN, seeded_hash
from ratelens.functions.rules import valid_age_rating, valid_studio
from ratelens.functions.text import comma_list, duration_minutes, feature_name, year_in_text


def evaluate(spark, text, function):
    return spark.createDataFrame([(text,)], "t string").select(function(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, minutes",
    [("1 hr 30 min per ep", 90), ("24 min per ep", 24), ("1 hr per ep", 60), ("2 hr", 120), ("30 sec per ep", None),
     ("Unknown", None), ("Through", None), (None, None)],
)
def test_duration(spark, text, minutes):
    assert evaluate(spark, text, duration_minutes) == minutes


@pytest.mark.parametrize(
    "text, first, last",
    [("Apr 3, 1998 to Apr 24, 1999", 1998, 1999), ("Apr 3", None, None), ("Not available", None, None), (None, None, None)],
)
def test_year(spark, text, first, last):
    assert evaluate(spark, text, lambda c: year_in_text(c, "first")) == first
    assert evaluate(spark, text, lambda c: year_in_text(c, "last")) == last


@pytest.mark.parametrize("text, number", [("12", 12), ("12.0", 12), ("7.9", None), ("UNKNOWN", None), ("", None), (None, None)])
def test_whole_numbers(spark, text, number):
    assert evaluate(spark, text, to_whole) == number
    assert evaluate(spark, text, to_known_whole) == number


def test_large_ids_keep_their_digits(spark):
    assert evaluate(spark, "9007199254740993", lambda c: to_whole(c, "bigint")) == 9007199254740993


@pytest.mark.parametrize(
    "text, day",
    [("2011-01-10T00:00:00+00:00", datetime.date(2011, 1, 10)), ("2011-01-10", datetime.date(2011, 1, 10)),
     ("soon", None), ("", None), (None, None)],
)
def test_iso_date(spark, text, day):
    assert evaluate(spark, text, iso_date) == day
    assert evaluate(spark, text, lambda c: typed(c, "date")) == day


def test_comma_list(spark):
    assert evaluate(spark, "Action,,Drama , Sci-Fi", comma_list) == ["Action", "Drama", "Sci-Fi"]
    assert evaluate(spark, "", comma_list) == []


@pytest.mark.parametrize(
    "text, valid",
    [("G - All Ages", True), ("PG-13 - Teens 13 or older", True), ("R - 17+ (violence & profanity)", True),
     ("UNKNOWN", True), ("24 min", False), ("12.5", False), ("https://x", False), ("spring 1998", False),
     ("Madhouse", False), ("R - 17+ " + "x" * 60, False), ("PG - Children in three", False)],
)
def test_age_rating_rule(spark, text, valid):
    assert evaluate(spark, text, valid_age_rating) is valid


@pytest.mark.parametrize(
    "text, valid",
    [("Sunrise", True), ("https://x", False), ("x" * 120, False), ("x" * 119 + ",", True), ("x," * 80, False)],
)
def test_studio_rule(spark, text, valid):
    assert evaluate(spark, text, valid_studio) is valid


def test_feature_names():
    assert feature_name("rating", "R - 17+ (violence & profanity)") == "rating_r_17plus_violence_profanity"
    assert feature_name("studio", "Brain's Base") == "studio_brain_s_base"
    assert feature_name("genre", "Slice of Life") == "genre_slice_of_life"


def test_seeded_hash_is_uniform_and_depends_on_the_seed(spark):
    hashed = spark.range(4000).select(seeded_hash(F.col("id")).alias("a"), seeded_hash(F.col("id"), 7).alias("b"))
    row = hashed.agg(F.avg("a"), F.min("a"), F.max("a"), F.sum((F.col("a") == F.col("b")).cast("int"))).first()
    assert abs(row[0] / HASH_SPAN - 0.5) < 0.02
    assert row[1] >= 0 and row[2] < HASH_SPAN and row[3] == 0
