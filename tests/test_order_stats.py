"""Exact order statistics against sorting."""

import math
import random

import pytest

from tremora.operators.order_stats import percentiles

SHARES = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def plain(values, share):
    values = sorted(values)
    at = share * (len(values) - 1)
    down, up = math.floor(at), math.ceil(at)
    if values[down] == values[up]:
        return values[down]
    return (up - at) * values[down] + (at - down) * values[up]


def cases():
    r = random.Random(1)
    skewed = [r.random() for _ in range(3000)] + [1e300, -1e300, 1e-300]
    return {
        "one": [3.5], "two": [1.0, 2.0], "ties": [7.0] * 500 + [8.0] * 499,
        "spread": [r.gauss(0, 10) for _ in range(5000)], "skewed": skewed,
        "huge": [r.choice([-1.7e308, 1.7e308, 0.0]) for _ in range(99)],
        "tiny": [k * 5e-324 for k in range(100)], "infinite": [1.0, 2.0, math.inf, -math.inf, 3.0],
        "near": [1 + k * 2.0 ** -52 for k in range(3000)],
    }


@pytest.mark.parametrize("name", sorted(cases()))
def test_percentiles_equal_a_sort(spark, name):
    values = cases()[name]
    data = [(v,) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(data, "v double").repartition(4)
    want = [plain(values, s) for s in SHARES]
    for options in ({}, {"bins": 8, "listed": 4}):
        assert percentiles(df, "v", SHARES, **options) == want, (name, options)


def test_without_numbers(spark):
    none = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert percentiles(none, "v", [0.5]) == percentiles(none.limit(0), "v", [0.5]) == [None]


def test_the_driver_sees_bins_only(spark):
    """However many rows, a pass brings back as many rows as there are bins."""
    df = spark.range(200_000).selectExpr("cast(pmod(id * 7919, 200000) as double) v").cache()
    assert percentiles(df, "v", [0.25, 0.5], bins=16, listed=8) == [49999.75, 99999.5]
