"""Exact co-moments against numpy and the built-in correlation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeledger.operators.comoments import wide_correlation
from tradeledger.operators.profiling import correlation_pairs


def table(spark, n, k, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, k)) + rng.normal(size=(n, k)) * rng.uniform(0.1, 5, k) + rng.normal(size=k) * 1e3
    x[rng.random(x.shape) < 0.1] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return x, spark.createDataFrame(rows, ", ".join(f"v{i} double" for i in range(k)))


def test_two_hundred_columns_in_one_pass(spark):
    x, df = table(spark, 1500, 200)
    got = {(r["column_x"], r["column_y"]): (r["r"], r["n"]) for r in wide_correlation(df).collect()}
    assert len(got) == 200 * 199 // 2
    rng = np.random.default_rng(1)
    for _ in range(300):
        i, j = sorted(rng.choice(200, 2, replace=False).tolist())
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        r, n = got[f"v{i}", f"v{j}"]
        assert n == both.sum() and r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_same_digits_on_any_partitioning_and_equal_to_the_narrow_way(spark):
    _, df = table(spark, 700, 6, 3)
    df = df.withColumns({"whole": F.round("v0").cast("int"), "constant": F.lit(5.0), "none": F.lit(None).cast("double"), "a.b`c": F.col("v1") * 2})
    key = lambda r: (r["column_x"], r["column_y"])
    one = {key(r): (r["r"], r["n"]) for r in wide_correlation(df.repartition(1)).collect()}
    for parts in (3, 11):
        assert {key(r): (r["r"], r["n"]) for r in wide_correlation(df.repartition(parts, F.rand(parts))).collect()} == one
    plain = [c for c in df.columns if c.isalnum()]
    for r in correlation_pairs(df, plain).collect():
        mine = one[key(r)]
        assert mine[1] == r["n"] and (mine[0] is None) == (r["r"] is None)
        assert r["r"] is None or mine[0] == pytest.approx(r["r"], abs=1e-9)


def test_missing_values_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (nan, 1.0), (4.0, inf), (5.0, None)], "x double, y double")
    r = wide_correlation(df).first()
    assert r["n"] == 3 and r["r"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1], abs=1e-12)
    assert [tuple(r) for r in wide_correlation(df.limit(0)).collect()] in ([], [("x", "y", None, 0)])
    assert wide_correlation(df, ["x"]).count() == 0
