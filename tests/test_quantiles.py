from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from packtrace.operators import quantiles
from packtrace.spec import Skew

PROBS = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]


def _samples():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(size=801),
        "ties": rng.integers(0, 3, 500).astype(float),
        "outliers": np.concatenate([rng.normal(size=400), [1e300, -1e300, 1e12]]),
        "constant": np.full(300, 4.25),
        "short": np.array([2.0]),
    }


@pytest.mark.parametrize("limit", [50, 10**9])
def test_matches_numpy(spark, limit):
    data = _samples()
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("normal", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = quantiles.by_group(df, ["k"], F.col("v"), PROBS, Skew(rows_per_task=limit)).collect()
    assert {r["k"] for r in got} == set(data)
    for r in got:
        assert np.allclose(r["quantiles"], np.quantile(data[r["k"]], PROBS), rtol=1e-12), r["k"]


def test_whole_table(spark):
    df = spark.range(1001).select((F.col("id") % 97).cast("double").alias("v"))
    want = np.quantile(np.arange(1001) % 97, PROBS)
    for limit in (100, 10**9):
        got = quantiles.by_group(df, [], F.col("v"), PROBS, Skew(rows_per_task=limit)).first()["quantiles"]
        assert np.allclose(got, want)


def test_approximate_switch(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    got = quantiles.by_group(df, [], F.col("v"), [0.5], approx=True).first()["quantiles"][0]
    assert abs(got - 500) <= 1


def test_infinite_values_count_as_extremes(spark):
    values = [float("-inf")] * 30 + [float(i) for i in range(200)] + [float("inf")] * 30
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.by_group(df, [], F.col("v"), [0.0, 0.5, 1.0], Skew(rows_per_task=40)).first()["quantiles"]
    assert got == [float("-inf"), 99.5, float("inf")]
