"""Exact quantiles: all values distinct, ties, hot keys, extremes, skew, rounds of narrowing."""

import math
import random

import numpy as np
import pytest

from citytherm.functions import stats

PROBS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0]


def check(got, values, probs=PROBS):
    want = np.quantile(np.array(values), probs)
    assert all(a == b or math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want)), (got, want)


def shapes():
    rng = np.random.default_rng(7)
    log = rng.lognormal(0, 4, 60_000)
    log[:5] = [1e12, -1e12, 1e18, 1e300, 5e-324]
    two_scales = np.concatenate((rng.normal(0, 1, 30_000), rng.normal(1e9, 1e-3, 30_000), [1e15] * 7))
    return {"log_normal_outliers": log, "two_scales": two_scales, "ties": rng.integers(0, 5, 50_000).astype(float),
            "one_value": np.full(30_000, 3.25), "few": np.array([4.0, 1.0, 9.5]), "one": np.array([2.0]), "distinct": rng.permutation(40_000).astype(float)}


@pytest.mark.parametrize("name", list(shapes()))
def test_columns_and_groups_equal_numpy(spark, name):
    values = shapes()[name]
    df = spark.createDataFrame([("hot", float(v)) for v in values] + [("cold", float(v)) for v in values[:50]] + [(None, float(v)) for v in values[:200]],
                               "k string, x double").repartition(5)
    check(stats.quantiles(df.where("k = 'hot'"), ["x"], PROBS).first()["q"], values)
    cut = name in ("log_normal_outliers", "ties")  # brackets cut again, round by round
    for bound in (1_000_000, 8) if cut else (1_000_000,):
        by = {r["k"]: r["q"] for r in stats.quantiles(df, ["x"], PROBS, keys="k", bound=bound).collect()}
        check(by["hot"], values)
        check(by["cold"], values[:50])
        check(by[None], values[:200])
    if cut:
        check(stats.quantiles(df.where("k = 'hot'"), ["x"], [0.25, 0.5], bound=20).first()["q"], values, [0.25, 0.5])


def test_infinities_nan_and_nulls(spark):
    rows = [(float("inf"),)] * 3 + [(float("-inf"),)] + [(float(i),) for i in range(100)] + [(float("nan"),), (None,)]
    got = stats.quantiles(spark.createDataFrame(rows, "x double"), ["x"], [0.0, 0.5, 1.0]).first()["q"]
    assert got == [float("-inf"), 50.5, float("inf")]


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    w = stats.wide_quantiles(df, ["a", "b"], [0.5], ["m"]).first()
    assert w["a__m"] is None and w["b__m"] == 1.5
    assert stats.quantiles(df.limit(0), ["a"], [0.5]).collect() == []
    assert stats.quantiles(df.limit(0), ["a"], [0.5], keys="b").collect() == []
    assert stats.global_median(df, "a", "m").first()["m"] is None


def test_no_task_counts_more_than_a_share(spark):
    """The counting pass keeps only brackets: far fewer rows than the input has values."""
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.lognormvariate(0, 5),) for _ in range(80_000)] + [(1e12,)], "x double")
    from pyspark.sql import functions as F
    kept = {}
    original = stats._at_ranks
    try:
        stats._at_ranks = lambda counts, g, probs: kept.setdefault("counts", counts) and original(counts, g, probs)
        stats.quantiles(df, ["x"], [0.25, 0.75]).collect()
    finally:
        stats._at_ranks = original
    assert kept["counts"].where(F.col("value").isNotNull()).count() < 80_000 * 2 * 3 * stats.MARGIN / stats.ACCURACY
