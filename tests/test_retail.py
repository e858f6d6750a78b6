from __future__ import annotations

import os

from ratelens.sources import retail
from ratelens.sources.readers import path_exists

SMALLEST = "/root/testdata/sf0.001"


def test_titles_are_dealt_out_by_rows(spark, monkeypatch):
    whole = retail._titles_view(spark, SMALLEST)
    n = whole.count()
    monkeypatch.setattr(retail, "TITLES_PER_FILE", n // 4)
    dealt = retail._titles_view(spark, SMALLEST)
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
    tasks = [len(rows) for rows in dealt.select("anime_id").rdd.glom().collect()]
    assert len(tasks) >= 4 and max(tasks) < n / 2


def test_lines_are_not_sorted_to_meet_their_orders(spark):
    plan = retail._ratings_view(spark, SMALLEST)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_star_needs_no_stored_ratings_and_reads_them_if_there(spark, tmp_path):
    facts = []
    for name in ("without", "with"):
        directory = str(tmp_path / name)
        os.symlink(SMALLEST, directory)
        if name == "with":
            retail.raw_ratings(spark, directory)
        facts.append(retail.retail_star(spark, directory).fact)
        stored = path_exists(spark, retail.stored_path(spark, directory, "ratings"))
        assert stored == (name == "with")
    assert facts[0].exceptAll(facts[1]).isEmpty() and facts[0].count() == facts[1].count() > 0
