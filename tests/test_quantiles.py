"""Exact distributed quantiles agree with pandas (linear interpolation)."""

import numpy as np
import pandas as pd
import pytest

from shelfwise.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("case", ["uniform", "hot_value", "tiny", "ties"])
def test_matches_pandas(spark, case):
    rng = np.random.default_rng(7)
    if case == "uniform":
        vals = rng.uniform(0, 1000, 5000).round(2)
    elif case == "hot_value":   # one value carries a third of the rows
        vals = np.concatenate([rng.uniform(0, 100, 4000).round(2), np.full(2000, 42.0)])
    elif case == "tiny":
        vals = np.array([3.0, 1.0])
    else:
        vals = rng.integers(0, 5, 1000).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    got = {r.p: r.value for r in exact_quantiles(df, "x", PROBS, buckets=16).collect()}
    want = pd.Series(vals).quantile(PROBS)
    for p in PROBS:
        assert got[p] == pytest.approx(want[p], abs=1e-9), p


def test_default_bucket_count_matches_pandas(spark):
    from pyspark.sql import functions as F
    df = spark.range(200_000).select((F.col("id") * 7 % 100_003 / 3.0).alias("x"))
    got = {r.p: r.value for r in exact_quantiles(df, "x", PROBS).collect()}
    want = df.toPandas()["x"].quantile(PROBS)
    for p in PROBS:
        assert got[p] == pytest.approx(want[p], abs=1e-9), p


def test_constant_and_empty_columns(spark):
    const = spark.createDataFrame(pd.DataFrame({"x": np.full(500, 7.25)}))
    got = {r.p: r.value for r in exact_quantiles(const, "x", PROBS).collect()}
    assert all(v == 7.25 for v in got.values()) and set(got) == set(PROBS)
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, "x", PROBS).count() == 0
