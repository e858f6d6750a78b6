from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratelens.operators.star import Star, date_dimension, ratings_fact, title_dimension, user_dimension  # noqa: E402
from ratelens.session import build_session  # noqa: E402
from rows import LONG_STUDIO, TITLE_SCHEMA, USER_SCHEMA, title, user  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def users(spark):
    rows = [
        user(30, "Male", "Canada", "2022-01-01T00:00:00+00:00", 5.0, 60, entries=10, dropped=2),
        user(10, "Female", "USA", "2022-01-02T00:00:00+00:00", 7.0, 60, entries=0, dropped=1),
        user(20, None, None, None, None, None),
        user(41, "Female", "Canada", "not a date", 5.5, 51),
        user(50, "Male", "USA", "2021-05-05T00:00:00+00:00", 9.0, 500, entries=4, dropped=1),
    ]
    return spark.createDataFrame(rows, USER_SCHEMA)


@pytest.fixture(scope="session")
def titles(spark):
    rows = [
        title(7, "Cowboy Bebop", "8.75", "Action, Sci-Fi", studios="Sunrise", popularity="43", source="Original"),
        title(3, "Alpha", "6.0", "Action,,Drama", kind="Movie", studios="Production I.G, Bones", popularity="2",
              members="900"),
        title(5, "Beta", "UNKNOWN", "", kind=None, episodes="Unknown", studios=None, popularity=None,
              rating="R - 17+ (violence & profanity)", duration="1 hr per ep"),
        title(9, "Gamma", "6.0", "Slice of Life", kind="Movie", episodes="1", studios="Production I.G, Bones",
              popularity="2", rating="R - 17+ (violence & profanity)", duration="1 hr 30 min per ep"),
        title(11, "Delta", "9.1", "Drama", episodes="3", studios="https://x", popularity="900", rating="24 min",
              duration="30 sec per ep", aired="Apr 3"),
        title(13, "Eta", "5.5", None, kind="OVA", studios=LONG_STUDIO, popularity="7", rating="UNKNOWN",
              duration="Unknown", aired="Not available"),
    ]
    return spark.createDataFrame(rows, TITLE_SCHEMA)


RATINGS = [
    (30, 7, 10), (30, 3, 1), (30, 9, 8), (10, 7, 10), (10, 3, 6), (10, 9, 1), (10, 5, 4), (41, 3, 8),
    (41, 11, 5), (50, 7, 7), (50, 13, 8), (50, 11, 10), (99, 7, 10), (30, 77, 9),
]


@pytest.fixture(scope="session")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id bigint, anime_id bigint, rating int")


@pytest.fixture(scope="session")
def star(spark, users, titles, ratings):
    dim_user, dim_anime = user_dimension(users), title_dimension(titles)
    dim_date = date_dimension(spark)
    fact = ratings_fact(ratings, dim_user, dim_anime, dim_date, load_date="2024-02-29")
    return Star(dim_user, dim_anime, dim_date, fact.cache())
