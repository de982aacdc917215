"""Exact percentiles by counting against numpy."""

import random

import numpy as np
import pytest

from terrapop.operators import quantiles


@pytest.mark.parametrize("buckets", [64, 65_536])
def test_percentiles(spark, buckets):
    rng = random.Random(buckets)
    groups = {"one": [3.5], "ties": [2.0] * 50 + [1.0] * 3, "wide": [rng.choice([1e-300, -1e300, 1e300, 0.0, 5.0]) for _ in range(40)], "many": [rng.gauss(0, 1) ** 9 for _ in range(700)], "near": [1 + k * 2**-52 for k in range(30)], "two": [1.0, 2.0]}
    rows = [(g, v) for g, some in groups.items() for v in some] + [("none", None), ("nan", float("nan")), ("one", None), (None, 4.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: [r.p0, r.p50, r.p95, r.p100] for r in quantiles.exact_percentiles(df, "g", "v", shares, buckets, 9).collect()}
    assert got.keys() - {None} == groups.keys()
    for g, some in groups.items():
        assert got[g] == pytest.approx([np.quantile(some, p) for p in shares.values()], rel=1e-9, abs=1e-9)


def test_empty(spark):
    assert quantiles.exact_percentiles(spark.createDataFrame([], "g string, v double"), "g", "v", {"p50": 0.5}).count() == 0
