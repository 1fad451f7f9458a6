import math
import random

import pytest

from ledgerloom.operators import quantile
from ledgerloom.operators.quantile import approximate_quantile, exact_quantile


def brute(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(round(p * len(values), 9))) - 1] if values else None


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("buckets", [2, 16, 4096])
def test_exact(spark, monkeypatch, p, buckets):
    monkeypatch.setattr(quantile, "SLICES", buckets)
    monkeypatch.setattr(quantile, "SLICES_PER_DOUBLING", 1 if buckets == 2 else 64)
    rng = random.Random(7)
    values = [rng.randrange(-500, 100_000) for _ in range(200)] + [77] * 100 + [None, 2**40, -(2**40)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert exact_quantile(df, "v", p) == brute(values, p)


def test_extremes_of_the_type(spark):
    values = [-(2**63), 2**63 - 1, 0, 5]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert exact_quantile(df, "v", 0.5) == 0
    assert exact_quantile(df, "v", 1.0) == 2**63 - 1


@pytest.mark.parametrize("values", [[], [None], [3], [3, 3, 3]])
def test_small(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert exact_quantile(df, "v", 0.95) == brute(values, 0.95)


def test_approximate_is_within_its_error(spark):
    df = spark.range(10_000)
    (row,) = approximate_quantile(df, "id", 0.95, 0.01).collect()
    assert 9_400 <= row.threshold <= 9_600
