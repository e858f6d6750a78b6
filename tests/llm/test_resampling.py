from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from ratelens.llm import resampling

SCHEMA = "doc_id bigint, text string"


def plain(texts, target, order, percent, least, buckets=10_000):
    def features(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(words[k : k + n]) for n in range(1, order + 1) for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    found = [(key, *features(text)) for key, text in texts]
    s, t = Counter(b for *_, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    every, wanted = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (every + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in s}
    out = []
    for key, n, f in found:
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= least])
    able = sorted([r for r in out if r[4]], key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: len(able) * percent // 100]
    ranks = {id(r): k + 1 for k, r in enumerate(drawn)}
    return [(*r[:4], ranks.get(id(r))) for r in out]


def order(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[1], r[4] or 0))


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    words = [rng.choice(("a", "B", "é", "x1", "_", "ß-")) * rng.randint(1, 3) + str(k) for k in range(80)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
    return [(k, text()) for k in range(n)], [" ".join(words[:30])] * 5


@pytest.mark.parametrize(("runs", "percent"), [(1, 10), (2, 33), (1, 100), (1, 0)])
def test_equals_brute_force(spark, runs, percent):
    rows, target = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(df, wanted, order=runs, percent=percent, least_words=10).collect()
    assert order(found) == order(plain(rows, target, runs, percent, 10))


@pytest.mark.parametrize("percent", [5, 30, 50, 70, 95])
def test_ties_at_the_cutoff(spark, percent):
    """Rows of one id have one noise, so equal texts tie; null ids come last."""
    words = "one two three four five six"
    rows = [(5, words)] * 30 + [(None, words)] * 10 + [(k, words) for k in range(20)] + [(3, words + " seven")] * 4
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = resampling.resample(df, df.limit(0), percent=percent, least_words=3).collect()
    assert order(found) == order(plain(rows, [], 1, percent, 3))


def test_cutoff_equals_sorting(spark):
    rng = random.Random(1)
    values = [rng.choice((-5, 0, 3, 10**12, rng.randint(-(10**6), 10**6))) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for wanted in (1, 2, 77, 199, 200):
        value = sorted(values)[wanted - 1]
        assert resampling._first_within(df, "v", wanted) == (value, sum(v < value for v in values))


def test_edge_cases(spark, documents, no_documents, clashing):
    from pyspark.sql import functions as F

    assert resampling.resample(no_documents, documents).collect() == []
    found = resampling.resample(documents, no_documents, percent=50).collect()
    assert len(found) == 12 and sum(r["rank"] is not None for r in found) == 3  # of seven with 20 words
    by = {r["id"]: r for r in found}
    assert by[4]["weight"] == by[5]["weight"] == by[4]["n_features"] == 0
    names = ("id", "n_words", "weight", "score", "position", "fall", "rank", "bucket")
    more = clashing.drop("id", "rank").select("*", *[F.lit(1).alias(n) for n in names])
    assert order(resampling.resample(more, no_documents, percent=50).collect()) == order(found)
