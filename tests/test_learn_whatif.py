"""H1-H3, H10, ridge closed form, F9, I6, I8 and payload parsing."""
import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytherm.operators import evaluate, learn, linear, scoring, split, whatif
from citytherm.sources import payloads


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    z = learn.standardize(df, ["a", "c"]).collect()
    assert [r.a for r in z] == [-1.0, 1.0] and [r.c for r in z] == [0.0, 0.0]


def test_holdout_25_groups(spark):
    df = spark.createDataFrame([(f"g{i}", j) for i in range(25) for j in range(3)], "g string, v int")
    a = split.group_holdout(df, "g", 0.2, 42)
    test = {r.g for r in a.where("split = 'test'").collect()}
    train = {r.g for r in a.where("split = 'train'").collect()}
    assert len(test) == 5 and len(train) == 20 and not (test & train)


def test_folds_partition_groups(spark):
    df = spark.createDataFrame([(f"g{i}", j) for i in range(12) for j in range(i + 1)], "g string, v int")
    f = split.group_folds(df, "g", 5).collect()
    assert len({r.g for r in f}) == 12
    sizes = {}
    for r in f:
        sizes[r.fold] = sizes.get(r.fold, 0) + r.n_rows
    assert sorted(sizes) == [0, 1, 2, 3, 4] and all(v > 0 for v in sizes.values())


def _greedy(sizes, k):
    loads, out = [0] * k, []
    for s in sizes:
        f = min(range(k), key=lambda j: (loads[j], j))
        loads[f] += s
        out.append(f)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 12)), max_size=8, unique_by=lambda r: r[0]), st.integers(1, 6))
def test_turns_equal_the_sequential_greedy(runs, k):
    runs = sorted(runs, reverse=True)
    entries = list(split.deal(runs, k))
    got = []
    for size, count in runs:
        mine = [(at, order) for s, at, _, order in entries if s == size]
        assert len(mine) <= k and mine[0][0] == 0
        for i in range(count):
            at, order = [m for m in mine if m[0] <= i][-1]
            got.append(order[(i - at) % len(order)])
    assert got == _greedy([s for s, c in runs for _ in range(c)], k)


def test_folds_equal_the_sequential_greedy(spark):
    rows = [(f"g{i}", j) for i in range(60) for j in range(1 + i * i % 13)] + [(None, 1)] * 5
    f = split.group_folds(spark.createDataFrame(rows, "g string, v int"), "g", 4)
    order = (f.withColumn("h", F.md5(F.concat(F.lit("42"), "g"))).orderBy(F.desc("n_rows"), "h", "g").collect())
    assert [r.fold for r in order] == _greedy([r.n_rows for r in order], 4)
    assert split.group_folds(f.limit(0), "g", 4).count() == 0
    assert sorted(r.fold for r in split.group_folds(spark.createDataFrame([("a",), ("b",), ("b",)], "g string"), "g", 5).collect()) == [0, 1]


def test_leaderboard_tie_goes_to_registry_order(spark):
    m = spark.createDataFrame([("B", 1, 1.0), ("A", 2, 1.0), ("C", 0, 2.0)], "model string, pos int, rmse double")
    lb = {r.model: r.rank for r in evaluate.leaderboard(m, "model", "rmse", "pos").collect()}
    assert lb == {"B": 1, "A": 2, "C": 3}


def _vectors(spark, X, y, extra=()):
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType()), T.StructField("fold", T.IntegerType())])
    return spark.createDataFrame([(Vectors.dense(x), float(t), int(i % 5)) for i, (x, t) in enumerate(zip(X, y))], schema)


def _candidate(name, profile="full"):
    return next(c for c in learn.build_candidates(profile) if c.name == name)


def _data(n=200):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(n, 3))
    return X, X @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=1.0 + (np.arange(n) % 5), size=n)


def _ridge(X, y, alpha):
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    return w, y.mean() - X.mean(0) @ w


def test_ridge_matches_closed_form(spark):
    X, y = _data()
    model = _candidate("Ridge Regression").fit(_vectors(spark, X, y), {"alpha": 10.0}, 200, float(np.std(y)))
    assert np.allclose(model.coefficients.toArray(), _ridge(X, y, 10.0)[0], atol=1e-6)


def test_ridge_fold_errors_match_closed_form(spark):
    X, y = _data(60)
    cand, fold = _candidate("Ridge Regression"), np.arange(60) % 5
    got = learn.fold_errors(_vectors(spark, X, y), "fold", cand, cand.grid_desc)
    for point, errors in zip(cand.grid_desc, got):
        for k, e in enumerate(errors):
            w, b = _ridge(X[fold != k], y[fold != k], point["alpha"])
            assert abs(e - np.sqrt(np.mean((X[fold == k] @ w + b - y[fold == k]) ** 2))) < 1e-6


def test_lasso_meets_its_optimality_conditions(spark):
    X, y = _data()
    alpha = 0.1
    model = _candidate("Lasso Regression").fit(_vectors(spark, X, y), {"alpha": alpha}, 200, float(np.std(y)))
    w = model.coefficients.toArray()
    Xc, yc = X - X.mean(0), y - y.mean()
    slope = Xc.T @ (yc - Xc @ w) / len(y)  # alpha * sign(w) where w is not 0
    assert all(abs(g - alpha * np.sign(v)) < 1e-3 if v else abs(g) <= alpha + 1e-3 for g, v in zip(slope, w))


def test_every_family_and_profile_fits(spark):
    """A step in one feature: trees and boosters find it, with its importance."""
    X = np.array([[i % 2, (i * 7) % 11, 1.0] for i in range(80)], dtype=float)
    y = 10.0 * X[:, 0]
    rows = _vectors(spark, X, y)
    for profile, names in (("full", learn.FULL_MODELS), ("fast", learn.FAST_MODELS)):
        cands = learn.build_candidates(profile)
        assert [c.name for c in cands] == list(names)
        for c in cands:
            point = min(c.grid_desc, key=lambda p: (p.get("n_estimators", 0), p.get("max_depth", 0), p.get("alpha", 0)))
            point = {**point, **({"n_estimators": 5} if "n_estimators" in point else {})}
            model = c.fit(rows, point, 80, float(np.std(y)))
            weights = dict(learn.feature_weights(model, ["step", "noise", "constant"]))
            assert max(weights, key=lambda f: abs(weights[f])) == "step"
    assert {p["max_depth"] for p in _candidate("Decision Tree").grid_desc} == {3, 5, 8, learn.MAX_TREE_DEPTH}


def test_importance_shares(spark):
    raw = spark.createDataFrame([("m", "a", -3.0), ("m", "b", 1.0), ("z", "a", 0.0)], "model string, feature string, weight double")
    got = {(r.model, r.feature): r.importance for r in learn.importance_shares(raw).collect()}
    assert got == {("m", "a"): 0.75, ("m", "b"): 0.25, ("z", "a"): 0.0}


def test_rows_without_group_are_left_out_and_counted(spark):
    df = spark.createDataFrame([(f"g{i % 10}" if i % 17 else None, float(i % 5), float(i % 5) * 2 + (i % 3)) for i in range(200)], "g string, x double, y double")
    res = learn.train_models(df, ["x"], "y", "g", models=["Linear Regression"])
    assert res.run.first()["n_rows_without_group"] == 12 and not res.failed
    assert {r["split"]: r["n"] for r in res.assignment.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 8, "test": 2}
    assert res.assignment.agg(F.sum("n_rows")).first()[0] == 188


def test_nearest_profiles_fifth_is_zero(spark):
    pts = spark.createDataFrame([(1, [0.0, 0.0])], "id int, v array<double>")
    prof = spark.createDataFrame([(k, [float(k), 0.0]) for k in range(1, 8)], "pk int, pv array<double>")
    for chunk in (256, 2):  # single chunk and the chunked merge give the same answer
        out = whatif.nearest_profiles(pts, prof, "id", "v", "pk", "pv", k=5, chunk=chunk).orderBy("rank").collect()
        assert [r.pk for r in out] == [1, 2, 3, 4, 5]
        assert out[-1].similarity == 0.0 and out[0].similarity == 80.0


def test_nearest_profiles_are_exact_and_cells_prune(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6)) * 20
    prof = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 6))
    pts = np.concatenate([centres[rng.integers(0, 12, 40)] + rng.normal(size=(40, 6)), rng.normal(size=(5, 6)) * 60, prof[:3]])
    pf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(prof)] + [(5000 + i, prof[7].tolist()) for i in range(9)], "pk int, pv array<double>")
    qf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(pts)], "id int, v array<double>")
    every = np.concatenate([prof, np.repeat(prof[7:8], 9, 0)])
    names = [*range(1500), *range(5000, 5009)]
    for chunk in (16, 300, 4000):
        got = {}
        for r in whatif.nearest_profiles(qf, pf, "id", "v", "pk", "pv", k=4, chunk=chunk).collect():
            got.setdefault(r.id, {})[r["rank"]] = (r.pk, r.distance)
        for i, v in enumerate(pts):
            d = np.sqrt(((every - v) ** 2).sum(1))
            want = sorted(zip(d.tolist(), names))[:4]
            assert [got[i][j + 1][0] for j in range(4)] == [n for _, n in want]
            assert np.allclose([got[i][j + 1][1] for j in range(4)], [x for x, _ in want])
    met = whatif.visited_share(qf.where("id < 40"), "v", pf, "pk", "pv", 2.0, rings=16).first()
    assert met.n_points == 40 and met.n_profiles == 1509 and met.visited < 0.25
    assert whatif.nearest_profiles(qf, pf.limit(0), "id", "v", "pk", "pv").count() == 0
    assert whatif.nearest_profiles(qf.limit(0), pf, "id", "v", "pk", "pv").count() == 0


def test_rules_order_and_default(spark):
    cols = "scenario_id int, temp double, hum double, wind double, ndvi double, uf double, clouds double"
    df = spark.createDataFrame([(1, 40.0, 90.0, 1.0, 0.1, 0.9, 10.0), (2, 20.0, 50.0, 5.0, 0.5, 0.3, 50.0)], cols)
    got = {}
    for r in whatif.rules(df).collect():
        got.setdefault(r.scenario_id, []).append((r.pos, r.rule))
    assert [x[1] for x in sorted(got[1])] == ["increase_greenery", "vegetation_cover",
                                              "ventilation_corridors", "cool_surfaces"]
    assert got[2] == [(0, whatif.DEFAULT_RULE)]


def test_contributions_top_and_width(spark):
    schema = T.StructType([T.StructField("scenario_id", T.IntegerType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame([(1, Vectors.dense([0.5, -2.0, 1.0]))], schema)
    out = whatif.contributions(df, ["a", "b", "c"], k=2).orderBy("rank").collect()
    assert [(r.feature, r.width) for r in out] == [("b", 1.0), ("c", 0.5)]


def test_contributions_order_of_nulls_nan_and_ties_without_a_lambda_comparator(spark):
    rows = [(1, [2.0, -2.0, 0.0, -0.0]), (2, [None, 1.0, float("nan"), -3.0])]
    top = whatif.contributions(spark.createDataFrame(rows, "id long, v array<double>"), ["b", "a", "d", "c"], key="id", vector_col="v", k=4)
    assert [r["feature"] for r in top.where("id = 1").orderBy("rank").collect()] == ["a", "b", "c", "d"]
    assert [r["feature"] for r in top.where("id = 2").orderBy("rank").collect()] == ["b", "c", "a", "d"]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_daily_payload_rules(spark):
    p = spark.createDataFrame(
        [("x", {"time": ["2024-01-01", "2024-01-02", "2024-01-03"],
                "temperature_2m_mean": [20.0, 21.0, 22.0],
                "relative_humidity_2m_mean": [50.0, None, 60.0],
                "wind_speed_10m_max": [36.0, 36.0, 18.0],
                "surface_pressure_mean": [None, 1000.0, 1001.0],
                "cloud_cover_mean": [0.0, 10.0, 20.4]})],
        payloads.DAILY_SCHEMA)
    sane = payloads.daily_rows(p).orderBy("time").collect()
    assert [r.time for r in sane] == ["2024-01-01", "2024-01-03"]  # null humidity drops the day
    assert (sane[0].pressure, sane[0].clouds, sane[0].wind_speed) == (1013.0, 0, 10.0)
    assert sane[0].timestamp == "2024-01-01T12:00:00" and sane[1].clouds == 20
    ref = payloads.daily_rows(p, zero_is_missing=True).orderBy("time").first()
    assert ref.clouds == 50


def test_current_payload_defaults(spark):
    p = spark.createDataFrame([("x", {"temp": 25.0, "humidity": 40.0, "pressure": None}, {"speed": 3.0},
                                None, 1704067200)], payloads.CURRENT_SCHEMA)
    r = payloads.current_row(p).first()
    assert (r.pressure, r.clouds, r.timestamp) == (1013.0, 50, "2024-01-01T00:00:00")
    assert dt is not None and F is not None


def test_lasso_from_statistics_meets_its_optimality_conditions(spark):
    X, y = _data()
    (s,) = linear.statistics(_vectors(spark, X, y), []).values()
    assert np.allclose(s.mean, [*X.mean(0), y.mean()]) and np.allclose(s.c[:-1, -1], (X - X.mean(0)).T @ (y - y.mean()))
    for alpha in (0.001, 0.1, 1.0, 100.0):
        w, b = linear.lasso(s, alpha)
        g = X.T @ (y - X @ w - b) / len(y)
        assert all(abs(abs(gj) - alpha) < 1e-8 and np.sign(gj) == np.sign(wj) if wj else abs(gj) <= alpha + 1e-9 for gj, wj in zip(g, w))
        assert abs(linear.rmse(s, (w, b)) - np.sqrt(np.mean((y - X @ w - b) ** 2))) < 1e-9


def test_linear_paths_equal_spark_fits(spark):
    """The statistics' fold errors equal models fitted on rows, also at penalties that leave dependent columns."""
    X, y = _data(90)
    X = np.column_stack([X, X[:, 0] - X[:, 1]])
    rows, fold = _vectors(spark, X, y), np.arange(90) % 5
    for name in ("Ridge Regression", "Lasso Regression"):
        cand = _candidate(name)
        errors = learn.fold_errors(rows, "fold", cand, cand.grid_desc)
        point = cand.grid_desc[2]
        for k in (0, 3):
            n, sd = int((fold != k).sum()), float(np.std(y[fold != k]))
            model = cand.fit(rows.where(f"fold <> {k}"), point, n, sd)
            got = X[fold == k] @ model.coefficients.toArray() + model.intercept - y[fold == k]
            assert abs(errors[2][k] - np.sqrt(np.mean(got ** 2))) < 1e-4
    plain = learn.fold_errors(rows, "fold", _candidate("Linear Regression"), [{}])[0]
    A = np.column_stack([X, np.ones(90)])
    w = np.linalg.lstsq(A[fold != 1], y[fold != 1], rcond=None)[0]
    assert abs(plain[1] - np.sqrt(np.mean((A[fold == 1] @ w - y[fold == 1]) ** 2))) < 1e-8


def test_prefixes_equal_separate_fits(spark):
    """Depths and steps read off one model give the fold errors of a fit for each point."""
    X, y = _data(150)
    y = y + np.sin(3 * X[:, 0]) * 4
    rows, fold = _vectors(spark, X, y).repartition(2).persist(), 2
    grids = {"Decision Tree": [{"max_depth": d, "min_samples_leaf": m} for d in (5, 2, 30) for m in (1, 4)],
             "Random Forest": [{"n_estimators": 4, "max_depth": d, "min_samples_leaf": 2} for d in (2, 4)],
             "Gradient Boosting": [{"n_estimators": n, "learning_rate": 0.1, "max_depth": 3, "subsample": s} for n in (3, 6) for s in (0.8, 1.0)]}
    for name, points in grids.items():
        cand = _candidate(name)
        got = learn.fold_errors(rows, "fold", cand, points)
        for point, errors in zip(points, got):
            model = cand.fit(rows.where(f"fold <> {fold}"), point, 120, 1.0)
            gap = F.col("prediction") - F.col("label")
            want = model.transform(rows.where(f"fold = {fold}")).agg(F.sqrt(F.avg(gap * gap))).first()[0]
            assert abs(errors[fold] - want) < 1e-9, (name, point)


def test_model_rows_score_like_the_models(spark):
    X, y = _data(120)
    rows = _vectors(spark, X, y + np.sin(4 * X[:, 1]) * 3)
    table = rows.select("features", F.col("label"), *[F.get(vector_to_array("features"), F.lit(i)).alias(f"x{i}") for i in range(3)])
    for name, point in (("Ridge Regression", {"alpha": 1.0}), ("Decision Tree", {"max_depth": 5, "min_samples_leaf": 1}),
                        ("Random Forest", {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 2}),
                        ("Gradient Boosting", {"n_estimators": 5, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0})):
        model = _candidate(name).fit(rows, point, 120, float(np.std(y)))
        both = scoring.predict(model.transform(table).withColumnRenamed("prediction", "want"), ["x0", "x1", "x2"], scoring.model_table(spark, {name: model}))
        assert both.where("abs(prediction - want) > 1e-9 OR prediction IS NULL").count() == 0, name
    gaps = spark.createDataFrame([(None, 1.0, 1.0), (float("nan"), 1.0, 1.0)], "x0 double, x1 double, x2 double")
    assert [r.prediction for r in scoring.predict(gaps, ["x0", "x1", "x2"], scoring.model_table(spark, {name: model})).collect()] == [None, None]


def test_leaf_floors_that_bind_nowhere_need_no_fit(spark):
    """Nodes that all hold enough rows answer for higher floors too; others are fitted again."""
    rng = np.random.default_rng(3)
    X = np.repeat(rng.integers(0, 2, (60, 2)).astype(float), 10, axis=0)
    rows = spark.createDataFrame([(Vectors.dense(v), float(v[0] * 3 + v[1] + 0.1 * (i % 5)), i % 3) for i, v in enumerate(X.tolist())],
                                 T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType()), T.StructField("fold", T.IntegerType())]))
    cand, fits = _candidate("Decision Tree"), []
    fit = type(cand).fit
    cand.fit = lambda data, point, n, std: fits.append(point["min_samples_leaf"]) or fit(cand, data, point, n, std)
    points = [{"max_depth": d, "min_samples_leaf": m} for d in (1, 3) for m in (1, 5, 150)]
    got = learn.fold_errors(rows, "fold", cand, points)
    assert sorted(fits) == [1, 1, 1, 150, 150, 150]
    for point, errors in zip(points, got):
        for k, e in enumerate(errors):
            model = fit(cand, rows.where(f"fold <> {k}"), point, 400, 1.0)
            gap = F.col("prediction") - F.col("label")
            assert abs(e - model.transform(rows.where(f"fold = {k}")).agg(F.sqrt(F.avg(gap * gap))).first()[0]) < 1e-9, point


def test_staged_vectors_take_more_files_for_more_rows_and_no_cache(spark, monkeypatch):
    rows = spark.range(400).select((F.col("id") % 20).cast("string").alias("g"), F.col("id").cast("double").alias("a"), F.rand(1).alias("y"))
    monkeypatch.setattr(learn, "PART_VALUES", 40)
    prep = learn.prepare(rows, ["a"], "y", "g")
    assert len(prep.rows.inputFiles()) == 20 and not prep.rows.storageLevel.useMemory
    assert prep.rows.count() == 400 and prep.n_train == 320


def test_prepare_counts_the_groups_once_with_equal_split_and_folds(spark, monkeypatch):
    rows = [(float(i), float(i % 4), f"g{i % 11}" if i % 13 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, g string")
    counted, sizes = [], split.group_sizes
    assign, outer = split.group_holdout(df, "g").collect(), split.group_folds(df, "g").collect()
    train = df.join(split.group_holdout(df, "g").where("split = 'train'").select("g"), "g")
    inner = split.group_folds(train, "g").collect()
    monkeypatch.setattr(split, "group_sizes", lambda *a: counted.append(a) or sizes(*a))
    prep = learn.prepare(df, ["x"], "y", "g")
    assert len(counted) == 1
    found = {r["g"]: r for r in prep.rows.select("g", "split", "fold", "outer_fold").distinct().collect()}
    assert {r["g"]: r["split"] for r in assign} == {g: r["split"] for g, r in found.items()}
    assert {r["g"]: r["fold"] for r in outer} == {g: r["outer_fold"] for g, r in found.items()}
    assert {r["g"]: r["fold"] for r in inner} == {g: r["fold"] for g, r in found.items() if r["fold"] is not None}
