"""Co-moments of all pairs: pairwise-complete, stable, mergeable."""
import math

import numpy as np
import pandas as pd

from citytherm.functions.moments import HELD_KEYS, co_moments
from citytherm.operators import profile


def frame(n, p, seed=1, offset=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) + offset
    x[rng.random((n, p)) < 0.1] = np.nan
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])


def test_correlations_equal_pandas_around_a_billion(spark):
    for p, offset in ((27, 1e9), (200, 0.0)):
        x = frame(600, p, offset=offset)
        df = spark.createDataFrame(x.astype(object).where(x.notna(), None), ", ".join(f"{c} double" for c in x)).repartition(7)
        want = x.corr()
        got = {(r.col_a, r.col_b): r.r for r in profile.corr_matrix(df, list(x)).collect()}
        assert len(got) == p * p
        assert all(math.isclose(got[a, b], want.loc[a, b], abs_tol=1e-6) for a in x for b in x)


def test_keys_nulls_constants_and_empty(spark):
    rows = [(k, float(v), 2.0, None if v % 3 else v * v * 1.0) for k in range(HELD_KEYS + 9) for v in range(7)] + [(None, 5.0, 2.0, None), (None, float("nan"), None, 1.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double").repartition(5)
    got = {(r.k, r.i, r.j): r for r in co_moments(df, ["a", "b", "c"], ["k"]).collect()}
    assert len(got) == 6 * (HELD_KEYS + 10) - sum(1 for key in [(None, 0, 2), (None, 1, 2)] if key not in got)
    r = got[HELD_KEYS, 0, 2]
    a, c = np.array([0.0, 3.0, 6.0]), np.array([0.0, 9.0, 36.0])
    assert (r.n, r.mean_i, r.mean_j) == (3, 3.0, 15.0)
    assert np.allclose([r.c_ii, r.c_jj, r.c_ij], [((a - 3) ** 2).sum(), ((c - 15) ** 2).sum(), ((a - 3) * (c - 15)).sum()])
    assert got[None, 0, 0].n == 1 and got[None, 0, 0].mean_i == 5.0
    const = {(r.col_a, r.col_b): r.r for r in profile.corr_matrix(df.where("k = 1"), ["a", "b"]).collect()}
    assert const == {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}
    assert co_moments(df.limit(0), ["a", "b"]).count() == 0


def test_whole_rows_in_keys_that_mix_and_miss(spark):
    """Batches without gaps and several keys, one null: the same sums as by hand."""
    rng = np.random.default_rng(5)
    x, a, b = rng.normal(size=(300, 3)) + 7, rng.integers(0, 3, 300), rng.integers(0, 4, 300)
    rows = [("ab"[v] if v < 2 else None, int(w), *map(float, r)) for v, w, r in zip(a, b, x)]
    got = {(r.s, r.k, r.i, r.j): r for r in co_moments(spark.createDataFrame(rows, "s string, k int, p double, q double, r double").repartition(3), ["p", "q", "r"], ["s", "k"]).collect()}
    assert len(got) == 6 * len({(u, v) for u, v, *_ in rows})
    for (s, k, i, j), r in got.items():
        own = np.array([row[2:] for row in rows if row[:2] == (s, k)])
        d = own - own.mean(0)
        assert r.n == len(own) and np.allclose([r.mean_i, r.mean_j, r.c_ii, r.c_jj, r.c_ij], [own[:, i].mean(), own[:, j].mean(), d[:, i] @ d[:, i], d[:, j] @ d[:, j], d[:, i] @ d[:, j]])
