from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest

from ratelens.operators.quantiles import exact_quantiles

FRACTIONS = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)


def plain(values, fraction):
    kept = sorted(v for v in values if v is not None)
    if not kept:
        return None
    return kept[max(1, math.ceil(Fraction(str(fraction)) * len(kept))) - 1]


def found(df, columns, **options):
    rows = exact_quantiles(df, columns, FRACTIONS, **options).collect()
    return {(r["column"], r["fraction"]): r["value"] for r in rows}


@pytest.mark.parametrize("options", [{}, {"accuracy": 100, "sorted_rows": 40}])
def test_exact_quantiles_equal_a_sort(spark, options):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([None, float(rng.randint(-5, 5))]),
            rng.random() * 10 ** rng.randint(-200, 200),
            7,
            None,
            1.0 if k < 400 else float(k),
        )
        for k in range(1200)
    ]
    names = ["ties", "wide range", "constant", "nothing", "hot"]
    df = spark.createDataFrame(
        rows, "ties double, `wide range` double, constant int, nothing double, hot double"
    ).repartition(5)
    got = found(df, names, **options)
    assert len(got) == len(names) * len(FRACTIONS)
    for k, name in enumerate(names):
        for fraction in FRACTIONS:
            expected = plain([row[k] for row in rows], fraction)
            assert got[name, fraction] == expected, (name, fraction)


def test_exact_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert found(df, ["a", "b"]) == {(c, f): None for c in "ab" for f in FRACTIONS}
    assert exact_quantiles(df, [], FRACTIONS).collect() == []
    assert exact_quantiles(df, ["a"], []).collect() == []


def test_infinite_values_and_nan(spark):
    values = [math.inf, -math.inf, 0.0, 1.0, math.nan] * 40
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = found(df, ["a"], accuracy=20, sorted_rows=30)
    assert got["a", 0.0] == -math.inf and got["a", 0.5] == 1.0 and got["a", 0.25] == 0.0
    assert math.isnan(got["a", 1.0]) and math.isnan(got["a", 0.9])
