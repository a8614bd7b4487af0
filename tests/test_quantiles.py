import random

import numpy as np
import pytest

from tillroll.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]


def found(spark, values):
    frame = spark.createDataFrame([(name, v) for name, vs in values.items() for v in vs], "name STRING, value BIGINT")
    return {(r.name, r.probability): r.quantile for r in exact_quantiles(frame, PROBABILITIES).collect()}


def test_against_brute_force(spark):
    rng = random.Random(7)
    values = {
        "wide": [rng.randint(-(2**50), 2**50) for _ in range(501)],
        "narrow": [rng.randint(-3, 3) for _ in range(1000)],
        "around_digit_borders": [b + d for b in (-(2**42), -(2**20), 0, 2**20, 2**42) for d in (-1, 0, 1)],
        "one": [42],
        "two": [1, 2],
    }
    result = found(spark, values)
    for name, numbers in values.items():
        for p in PROBABILITIES:
            assert result[name, p] == pytest.approx(float(np.quantile(numbers, p)), rel=1e-12), (name, p)


def test_hot_value(spark):
    result = found(spark, {"hot": [5] * 4000 + list(range(1000, 9000))})
    assert result["hot", 0.25] == 5.0
    assert result["hot", 0.5] == float(np.quantile([5] * 4000 + list(range(1000, 9000)), 0.5))


def test_nulls_are_ignored_and_nothing_gives_nothing(spark):
    assert found(spark, {"a": [None, 1, None, 3]})["a", 0.5] == 2.0
    assert found(spark, {"a": [None]}) == {}
