"""Exact distributed selection against sorting."""

import math
import random
import statistics

import pytest

from tidecast.operators import selection


@pytest.mark.parametrize("kind", ["uniform", "ties", "wide", "two", "negative", "even", "one"])
def test_median_equals_sorting(spark, kind):
    rng = random.Random(hash(kind) % 100)
    data = {"uniform": [rng.random() * 1000 for _ in range(3001)], "ties": [float(rng.randint(1, 4)) for _ in range(500)],
            "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(700)], "two": [1e308, -1e308] * 50 + [0.5],
            "negative": [-rng.expovariate(1) for _ in range(800)], "even": [1.0, 2.0, 4.0, 8.0], "one": [3.5]}[kind]
    df = spark.createDataFrame([(x,) for x in [*data, None, None, float("nan")]], "d double")
    for bound, ranges in ((selection.BOUND, 64), (16, 8), (2, 3)):
        assert math.isclose(selection.median(df, "d", bound, ranges), statistics.median(data), rel_tol=1e-12)


def test_no_values(spark):
    assert selection.median(spark.createDataFrame([(None,)], "d double"), "d") is None
    assert selection.median(spark.createDataFrame([], "d double"), "d") is None


def test_values_at_every_rank(spark):
    data = sorted(round(math.sin(k) * 50, 1) for k in range(90))
    df = spark.createDataFrame([(x,) for x in data], "v double")
    for rank in range(0, 90, 11):
        assert selection.value_at(df, rank, bound=5, ranges=4) == data[rank]
