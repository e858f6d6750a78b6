from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ratelens.llm import centroids


def plain(rows, dimensions, clusters, rounds):
    kept = [
        (key, [int(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024) for x in v]) for key, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centres)), key=lambda c: (away(v, centres[c]), c))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v), []).append(v)
        centres = [[sum(x) // len(own[c]) for x in zip(*own[c])] if c in own else old for c, old in enumerate(centres)]
    out = [(key, c, away(v, centres[c])) for key, v in kept for c in [nearest(v)]]
    inertia = {c: sum(d for _, k, d in out if k == c) for c in range(len(centres))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    long = lambda x: x if x < 2**63 else None
    return [(key, c, long(d), long(inertia[c]), long(sum(inertia.values())), digests[c]) for key, c, d in out]


def order(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1], str(r[2])))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(spark, kind):
    rng = random.Random(2)
    middle = [[rng.uniform(-2, 2) for _ in range(6)] for _ in range(5)]
    rows = [(k, [float(np.float32(x + rng.gauss(0, 0.6))) for x in rng.choice(middle)]) for k in range(300)]
    rows += [(k, [round(x) * 0.5 for x in v]) for k, v in rows[:100]]  # ties, repeated ids
    rows += [(7, None), (8, [1.0] * 5), (9, [1.0] * 7), (10, [1.0] * 5 + [None]), (11, [math.inf] + [0.0] * 5)]
    rows += [(12, [math.nan] * 6), (13, []), (None, [0.25] * 6), (14, [0.25] * 6)]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(4)
    found = centroids.cluster(df, dimensions=6, clusters=5, rounds=4)
    assert order(found.collect()) == order(plain(rows, 6, 5, 4))


def test_huge_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(k, [rng.choice((1e-3, 1.0, 3e5, 1e12, 1e300)) * rng.uniform(-1, 1) for _ in range(3)]) for k in range(60)]
    rows += [(60, [1e308, -1e308, 1.7e308]), (61, [0.1, 0.2, 0.3])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    found = order(centroids.cluster(df, dimensions=3, clusters=4, rounds=3).collect())
    assert found == order(plain(rows, 3, 4, 3))
    assert any(r[2] is None for r in found)


def test_a_test_for_each_challenger_finds_the_nearest():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3, 4, (9, 4)).tolist()
    rows = rng.integers(-4, 5, (2000, 4)).astype(float)
    winner, distance = centroids.Bisectors(centres).nearest(rows)
    every = ((rows[:, None, :] - np.array(centres)[None]) ** 2).sum(axis=2)
    assert winner.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_sums_in_parts():
    for total in (0, 5, -5, 1 << 40, -(1 << 90) + 12345, (1 << 40) - 1):
        assert sum(part << (40 * place) for place, part in centroids._limbs(total)) == total


def test_edge_cases(spark):
    from pyspark.sql import functions as F

    schema = "vec_id bigint, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema)).collect() == []
    few = spark.createDataFrame([(1, [1.0] * 64), (1, [1.0] * 64), (2, [2.0] * 64), (3, None)], schema)
    found = centroids.cluster(few).collect()
    assert len(found) == 3 and {r["distance"] for r in found} == {0}  # equal centroids: the smaller number takes all
    names = ("id", "vector", "cluster", "distance", "hash", "inertia")
    clashing = few.select("*", *[F.lit(1).alias(n) for n in names])
    assert sorted(centroids.cluster(clashing).collect()) == sorted(found)
