"""Schemas and rows of users and titles that the tests build their tables from."""

from __future__ import annotations

USER_SCHEMA = (
    "`Mal ID` bigint, Username string, Gender string, Birthday string, Location string, Joined string, "
    "`Days Watched` double, `Mean Score` double, Watching int, Completed int, `On Hold` int, Dropped int, "
    "`Plan to Watch` int, `Total Entries` int, Rewatched int, `Episodes Watched` int"
)
TITLE_SCHEMA = (
    "anime_id bigint, Name string, `English name` string, Score string, Genres string, Type string, "
    "Episodes string, Aired string, Premiered string, Status string, Producers string, Studios string, "
    "Source string, Duration string, Rating string, Rank string, Popularity string, Favorites string, "
    "`Scored By` string, Members string, Watching string, Completed string, `On-Hold` string, Dropped string"
)
LONG_STUDIO = "x" * 60 + " " + "y" * 59


def user(uid, gender=None, location=None, joined=None, mean=None, completed=None, entries=0, dropped=0):
    return (
        uid, f"user{uid}", gender, "1985-03-04T00:00:00+00:00" if uid % 2 else None, location, joined,
        1.5, mean, 1, completed, 2, dropped, 3, entries, 4, 100,
    )


def title(
    aid, name, score="7.5", genres="Action, Drama", kind="TV", episodes="12", studios="Sunrise", source="Manga",
    rating="PG-13 - Teens 13 or older", popularity="1", members="5000", duration="24 min per ep",
    aired="Apr 3, 1998 to Apr 24, 1999",
):
    return (
        aid, name, name.upper(), score, genres, kind, episodes, aired, "spring 1998", "Finished Airing", "P", studios,
        source, duration, rating, "1.0", popularity, "10", "20", members, "5", "6", "7", "8",
    )
