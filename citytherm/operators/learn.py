"""Model training and comparison with Spark ML.

Every fit is a distributed Spark ML job; the driver only loops over the
model registry and parameter grid (as the reference does) and keeps the
fitted parameters (a few numbers per model).

* H1 population-std scaler: fitted as a one-row aggregate and applied as a
  ``SQLTransformer`` stage, so the scaler is part of the persisted
  ``PipelineModel`` (Spark's ``StandardScaler`` divides by the sample std).
* H5 models: LinearRegression (plain, ridge, lasso), DecisionTree,
  RandomForest, GBT, and two further GBT profiles standing in for the two
  optional third-party boosters.
* H6 grid search and H7 outer CV of the linear models: no fits at all, every
  penalty and fold follows from one pass of cross-products (``operators.linear``).
* H6/H7 of the tree models: fits on filters of one staged table.  Depths of trees
  and forests and steps of boosters are read off one fit at the largest
  (``operators.trees``), so a grid needs one fit for each other setting and fold;
  a least leaf size that no node falls short of needs none of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citytherm.functions.expressions import round_half_even
from citytherm.functions.stats import scalars
from citytherm.operators import evaluate, linear, split, trees
from citytherm.sources.stages import materialize

SEED = 42
MAX_TREE_DEPTH = 30  # Spark's limit; stands in for "no depth limit"

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# --------------------------------------------------------------------------
# Parameter grids, full profile (reference parameter names).
PARAM_GRIDS = {
    "Ridge Regression": {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]},
    "Lasso Regression": {"alpha": [0.001, 0.01, 0.1, 1.0]},
    "Decision Tree": {"max_depth": [3, 5, 8, None], "min_samples_leaf": [1, 2, 5]},
    "Random Forest": {"n_estimators": [100, 200], "max_depth": [5, 8, None],
                      "min_samples_leaf": [1, 2]},
    "Gradient Boosting": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1],
                          "max_depth": [3, 5]},
    "Boosting A": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1],
                   "max_depth": [4, 6], "subsample": [0.8, 1.0]},
    "Boosting B": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1],
                   "max_depth": [4, 6]},
}
# Parameter grids, fast profile.
FAST_PARAM_GRIDS = {
    "Ridge Regression": {"alpha": [0.1, 1.0, 10.0]},
    "Decision Tree": {"max_depth": [4, 6, 8], "min_samples_leaf": [1, 2, 5]},
    "Random Forest": {"n_estimators": [50, 100], "max_depth": [6, 8, None],
                      "min_samples_leaf": [1, 2]},
    "Boosting A": {"n_estimators": [50, 100], "learning_rate": [0.05, 0.1],
                   "max_depth": [3, 4], "subsample": [0.9, 1.0]},
    "Boosting B": {"n_estimators": [50, 100], "learning_rate": [0.05, 0.1],
                   "max_depth": [3, 4]},
}
# Model registry order (ties in test RMSE go to the earlier model).
FULL_MODELS = ["Linear Regression", "Ridge Regression", "Lasso Regression", "Decision Tree",
               "Random Forest", "Gradient Boosting", "Boosting A", "Boosting B"]
FAST_MODELS = ["Linear Regression", "Ridge Regression", "Decision Tree", "Random Forest",
               "Boosting A", "Boosting B"]
# Fast-profile base settings of the models without a grid entry.
FAST_BASE = {
    "Decision Tree": {"max_depth": 5, "min_samples_leaf": 2},
    "Random Forest": {"n_estimators": 50, "max_depth": 8, "min_samples_leaf": 2},
    "Boosting A": {"n_estimators": 50, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.9},
    "Boosting B": {"n_estimators": 50, "max_depth": 4, "learning_rate": 0.1},
}
TEST_SIZE = 0.2
CV_FOLDS = 5
SCALER_COLUMNS = 14        # columns of one aggregate of means and stds
PART_VALUES = 6_000_000    # numbers of a file of the staged vectors, about 50 MB
PARALLEL_ROWS = 4_000_000  # rows of all fits that run at once: each keeps its binned rows in memory


# --------------------------------------------------------------------------
# H1: standardisation
# --------------------------------------------------------------------------
def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column (one-row aggregates, 2p numbers).

    Each aggregate reads its own ``SCALER_COLUMNS`` columns: five sums a column for all
    of them at once would pass the width that Spark compiles."""
    out = {}
    for at in range(0, len(cols), SCALER_COLUMNS):
        own = cols[at:at + SCALER_COLUMNS]
        row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(own)],
                     *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(own)]).first()
        out |= {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(own)}
    return out


def standardize(df: DataFrame, cols: Sequence[str], prefix: str = "", fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column (std 0) becomes 0.

    Lazy form: the statistics are a one-row aggregate read as a scalar subquery.
    """
    src = fit_on if fit_on is not None else df
    st = scalars(src.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                         *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols]))
    z = {f"{prefix}{c}": F.when(st(f"_s_{c}") > 0, (F.col(c) - st(f"_m_{c}")) / st(f"_s_{c}"))
                          .otherwise(F.lit(0.0)) for c in cols}
    return df.withColumns(z)


def scaler_stage(stats: dict[str, tuple[float, float]], out_prefix: str = "z_") -> SQLTransformer:
    """The fitted scaler as a persistable pipeline stage."""
    parts = []
    for c, (m, s) in stats.items():
        if s is None or s == 0 or m is None:
            parts.append(f"CAST(0.0 AS DOUBLE) AS `{out_prefix}{c}`")
        else:
            parts.append(f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}) AS `{out_prefix}{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


# --------------------------------------------------------------------------
# H5: model registry
# --------------------------------------------------------------------------
@dataclass
class Candidate:
    """A registry entry.  ``settings(point, n, std)`` gives the Spark parameters
    of a grid point for training rows of that number and label spread."""
    name: str
    estimator: object
    grid_desc: list[dict]  # reference parameter names
    settings: Callable[[dict, int, float], dict]
    solve: linear.Solver | None = None  # from sufficient statistics, for linear models
    nested: str | None = None  # parameter whose smaller values are prefixes of the largest one's model
    floor: str | None = None   # parameter that only forbids nodes of fewer rows

    def fit(self, rows: DataFrame, point: dict, n: int, std: float):
        return self.estimator.copy(self.settings(point, n, std)).fit(rows)


def _tree_depth(d):
    return MAX_TREE_DEPTH if d is None else int(d)


def _combos(spec: dict) -> list[dict]:
    out = [{}]
    for k, vals in spec.items():
        out = [{**o, k: v} for o in out for v in vals]
    return out


def build_candidates(profile: str, features_col: str = "features", label: str = "label") -> list[Candidate]:
    """Estimators and grids of a profile ("full" or "fast").

    Ridge alpha maps to Spark's regParam as alpha * std(y) / n of the rows that
    are trained on (normal solver, no standardisation); lasso alpha maps 1:1
    (elasticNet 1).  "No depth limit" is Spark's limit, and the point says so.
    """
    fast = profile == "fast"
    kw = dict(featuresCol=features_col, labelCol=label, predictionCol="prediction")
    out = []
    for name in FAST_MODELS if fast else FULL_MODELS:
        spec = (FAST_PARAM_GRIDS if fast else PARAM_GRIDS).get(name)
        base = FAST_BASE.get(name, {}) if fast else {}
        if name in ("Linear Regression", "Ridge Regression", "Lasso Regression"):
            lasso = name == "Lasso Regression"
            est = LinearRegression(regParam=0.0, elasticNetParam=float(lasso), standardization=False,
                                   solver="auto" if lasso else "normal", maxIter=5000, **kw)
            base = {"alpha": 1.0} if name == "Ridge Regression" else {}

            def settings(c, n, std, est=est, lasso=lasso):
                alpha = c.get("alpha", 0.0)
                return {est.regParam: float(alpha if lasso else alpha * std / max(n, 1))}
        elif name in ("Decision Tree", "Random Forest"):
            forest = name == "Random Forest"
            est = (RandomForestRegressor(seed=SEED, featureSubsetStrategy="all", maxBins=64, **kw) if forest
                   else DecisionTreeRegressor(seed=SEED, maxBins=64, **kw))
            base = {"max_depth": None, "min_samples_leaf": 1, **({"n_estimators": 100} if forest else {}), **base}

            def settings(c, n, std, est=est, forest=forest):
                p = {est.maxDepth: _tree_depth(c["max_depth"]), est.minInstancesPerNode: int(c["min_samples_leaf"])}
                return p | ({est.numTrees: int(c["n_estimators"])} if forest else {})
        else:  # gradient boosting and the two booster profiles
            est = GBTRegressor(seed=SEED, maxBins=64, **kw)
            base = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0, **base}

            def settings(c, n, std, est=est):
                return {est.maxIter: int(c["n_estimators"]), est.stepSize: float(c["learning_rate"]),
                        est.maxDepth: int(c["max_depth"]), est.subsamplingRate: float(c["subsample"])}
        points = [{**base, **c} for c in _combos(spec)] if spec else [base]
        for c in points:
            if "max_depth" in c:
                c["max_depth"] = _tree_depth(c["max_depth"])
        solve = {"Linear Regression": linear.ridge, "Ridge Regression": linear.ridge, "Lasso Regression": linear.lasso}.get(name)
        nested = None if solve else "max_depth" if name in ("Decision Tree", "Random Forest") else "n_estimators"
        floor = "min_samples_leaf" if nested == "max_depth" else None
        out.append(Candidate(name, est, points, settings, solve, nested, floor))
    return out


# --------------------------------------------------------------------------
# Training run
# --------------------------------------------------------------------------
@dataclass
class RunResult:
    run_id: str
    best_model: str
    best_pipeline: PipelineModel
    run: DataFrame                 # one row (H14)
    model_metric: DataFrame        # one row per model
    feature_importance: DataFrame  # one row per (model, feature)
    assignment: DataFrame          # (run_id, group, n_rows, split): one row per group
    failed: dict[str, str]         # model -> error (H10)


def importance_shares(raw: DataFrame) -> DataFrame:
    """(model, feature, weight) -> importance, the share of |weight| in the
    model's total (plus 1e-9), to 5 places."""
    total = F.sum(F.abs("weight")).over(Window.partitionBy("model")) + F.lit(1e-9)
    return raw.select("model", "feature", round_half_even(F.abs("weight") / total, 5).alias("importance"))


def feature_weights(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, weight) of a fitted model, tree or linear; empty for others."""
    vector = getattr(model, "featureImportances", None) or getattr(model, "coefficients", None)
    return [] if vector is None else [(n, float(w)) for n, w in zip(names, vector.toArray())]


@dataclass
class Prepared:
    """Group split, folds and scaled vectors shared by every fit of a run: one
    staged table (features, label, group, split, fold, outer_fold)."""
    rows: DataFrame
    assign: DataFrame      # (group, n_rows, split)
    scaler: SQLTransformer
    assembler: VectorAssembler
    n_train: int
    label_std: float
    n_no_group: int = 0    # labelled rows without a group, left out
    statistics: dict | None = None  # of (split, fold, outer_fold), computed when first asked for

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col("split") == "test")

    def folds(self, fold: str) -> dict:
        """Sufficient statistics of each "fold" (training rows) or "outer_fold"
        (all rows): one pass over the rows for both."""
        if self.statistics is None:
            self.statistics = linear.statistics(self.rows, ["split", "fold", "outer_fold"])
        own: dict[int, list] = {}
        for (part, inner, outer), s in sorted(self.statistics.items(), key=str):
            if fold == "outer_fold" or part == "train":
                own.setdefault(inner if fold == "fold" else outer, []).append(s)
        return {k: linear.merged(v) for k, v in own.items() if k is not None}


def prepare(table: DataFrame, features: Sequence[str], label: str, group: str,
            folds: int = CV_FOLDS, test_size: float = TEST_SIZE, seed: int = SEED,
            fit_scope: str = "train", keep: Sequence[str] = ()) -> Prepared:
    """H2 split, H3 folds (inner on training groups, outer on all groups),
    H1 scaler fitted on ``fit_scope`` rows, vectors assembled and staged once.

    A labelled row without a group can be in no split: such rows are left out
    and counted.
    """
    feats = list(features)
    labelled = table.where(F.col(label).isNotNull())
    d = labelled.where(F.col(group).isNotNull())
    # groups are counted once; a split keeps whole groups, so their sizes hold in it too
    sizes = materialize(split.group_sizes(d, group), "sizes")
    assign = materialize(split.group_holdout(d, group, test_size, seed, sizes), "split")
    outer = split.group_folds(d, group, folds, sizes=sizes).select(group, F.col("fold").alias("outer_fold"))
    in_train = assign.where(F.col("split") == "train").select(group, "n_rows")
    inner = split.group_folds(d, group, folds, sizes=in_train).select(group, "fold")
    # one row per group: split and both folds, joined to the rows once
    groups = materialize(assign.join(outer, group).join(inner, group, "left"), "groups")
    rows = d.join(groups.drop("n_rows"), group)
    stats = fit_scaler(rows.where(F.col("split") == "train") if fit_scope == "train" else rows, feats)
    scaler = scaler_stage(stats)
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in feats], outputCol="features",
                                handleInvalid="keep")
    vectors = PipelineModel(stages=[scaler, assembler]).transform(rows)
    cores = table.sparkSession.sparkContext.defaultParallelism
    # staged in the shared folder, so a lost executor rereads it; dealt over the
    # cores at least, because every fit passes over it; files are as many as the rows
    # need, and not cached: memory is left to the binned rows that a fit keeps
    n = groups.agg(F.sum("n_rows")).first()[0] or 0
    parts = max(cores, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * (len(feats) + 1) // PART_VALUES))
    staged = materialize(vectors.select("features", F.col(label).cast("double").alias("label"), group, "split", "fold",
                                        "outer_fold", *keep).repartition(parts), "vectors")
    st = staged.where(F.col("split") == "train").agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    return Prepared(staged, groups.select(group, "n_rows", "split"), scaler, assembler, int(st["n"]), float(st["s"] or 0.0),
                    labelled.where(F.col(group).isNull()).count())


def fold_errors(rows: DataFrame, fold: str, cand: Candidate, points: Sequence[dict], parallelism: int = 4,
                folds: dict | None = None) -> list[list[float]]:
    """RMSE of every (point, fold): fitted on the other folds, with settings from
    their own number of rows and label spread.  Linear models are solved from
    ``folds``, the folds' sufficient statistics (one pass if not given)."""
    if cand.solve is not None:
        if folds is None:
            folds = {k: s for (k,), s in linear.statistics(rows.where(F.col(fold).isNotNull()), [fold]).items()}
        return linear.fold_errors(folds, cand.solve, [p.get("alpha", 0.0) for p in points])
    known = [r[0] for r in rows.where(F.col(fold).isNotNull()).select(fold).distinct().orderBy(fold).collect()]  # k numbers
    others = rows.agg(*[f for k in known for f in (F.count_if(F.col(fold) != k).alias(f"n{k}"),
                                                   F.stddev_pop(F.when(F.col(fold) != k, F.col("label"))).alias(f"s{k}"))]).first()

    # points that differ in the nested parameter and the floor only share fits
    families: dict[str, list[int]] = {}
    for i, p in enumerate(points):
        families.setdefault(repr(sorted((c, v) for c, v in p.items() if c not in (cand.nested, cand.floor))), []).append(i)

    def one(task):
        own, k = task
        floor = {i: int(points[i][cand.floor]) if cand.floor else 0 for i in own}
        left, found = sorted(own, key=floor.get), {}
        while left:
            # a model with no node below a higher floor is the model of that floor too: each of
            # its splits was the best of all, so it is the best of those that the floor allows
            least = floor[left[0]]
            deepest = max(left, key=lambda i: int(points[i][cand.nested]))
            point = {**points[deepest], **({cand.floor: least} if cand.floor else {})}
            model = cand.fit(rows.where(F.col(fold) != k), point, others[f"n{k}"], float(others[f"s{k}"] or 0.0))
            nodes = trees.nodes_of(rows.sparkSession, model)
            mine = [i for i in left if floor[i] <= max(least, nodes.smallest)]
            errors = trees.prefix_errors(rows.where(F.col(fold) == k), nodes, [int(points[i][cand.nested]) for i in mine], "features", "label")
            found |= dict(zip(mine, errors))
            left = [i for i in left if i not in found]
        return [found[i] for i in own]
    tasks = [(own, k) for own in families.values() for k in known]
    most = max([others[f"n{k}"] for k in known], default=0)
    at_once = max(1, min(parallelism, len(tasks), PARALLEL_ROWS // max(most, 1)))
    with ThreadPool(at_once) as pool:
        flat = pool.map(inheritable_thread_target(rows.sparkSession)(one), tasks, chunksize=1)
    out = [[0.0] * len(known) for _ in points]
    for (own, k), errors in zip(tasks, flat):
        for i, e in zip(own, errors):
            out[i][known.index(k)] = e
    return out


def mean_std(values: Sequence[float]) -> tuple[float, float]:
    """Mean and population std."""
    m = sum(values) / len(values)
    return m, (sum((v - m) ** 2 for v in values) / len(values)) ** 0.5


def grid_cv(prep: Prepared, cand: Candidate, parallelism: int = 4) -> tuple[int, list[float], list[float]]:
    """H6: group-fold grid search of one candidate: best index (first of equals),
    mean and population std of the fold RMSE per point."""
    folds = prep.folds("fold") if cand.solve is not None else None
    found = [mean_std(e) for e in fold_errors(prep.train, "fold", cand, cand.grid_desc, parallelism, folds)]
    avg = [m for m, _ in found]
    return avg.index(min(avg)), avg, [s for _, s in found]


_METRIC = ("model string, registry_pos int, rmse double, mae double, r2 double, cv_rmse double, cv_std double, "
           "skill_vs_baseline double, best_params map<string,string>")


def train_models(table: DataFrame, features: Sequence[str], label: str, group: str,
                 profile: str = "fast", models: Sequence[str] | None = None,
                 folds: int = CV_FOLDS, test_size: float = TEST_SIZE, seed: int = SEED,
                 fit_scope: str = "train", parallelism: int = 4,
                 outer_cv: bool = True) -> RunResult:
    """Train and compare the registry on a group hold-out split.

    ``fit_scope="train"`` fits the scaler on training groups only;
    ``"all"`` reproduces the reference (fitted on every row).
    """
    spark: SparkSession = table.sparkSession
    feats = list(features)
    prep = prepare(table, feats, label, group, folds, test_size, seed, fit_scope)
    base = evaluate.regression_metrics(evaluate.baseline_predictions(prep.train, prep.test, "label", "prediction"),
                                       "label", "prediction").first()
    fitted, rows, weights, failed = {}, [], [], {}
    for pos, cand in enumerate(build_candidates(profile)):
        if models is not None and cand.name not in models:
            continue
        try:
            point = cand.grid_desc[grid_cv(prep, cand, parallelism)[0] if len(cand.grid_desc) > 1 else 0]
            model = cand.fit(prep.train, point, prep.n_train, prep.label_std)
            m = evaluate.regression_metrics(model.transform(prep.test), "label", "prediction").first()
            folds = prep.folds("outer_fold") if cand.solve is not None and outer_cv else None
            cv = mean_std(fold_errors(prep.rows, "outer_fold", cand, [point], parallelism, folds)[0]) if outer_cv else (None, None)
        except Exception as e:  # H10: a failing model is reported and left out
            failed[cand.name] = f"{type(e).__name__}: {e}"
            continue
        fitted[cand.name] = model
        rows.append((cand.name, pos, *map(float, (m["rmse"], m["mae"], m["r2"])), *cv,
                     1.0 - m["rmse"] / (base["rmse"] + 1e-9), {k: str(v) for k, v in point.items()}))
        weights += [(cand.name, f, w) for f, w in feature_weights(model, feats)]
    if not fitted:
        raise RuntimeError(f"every model failed to train: {failed}")

    run_id = F.lit(uuid.uuid4().hex[:12])
    metric = spark.createDataFrame(rows, _METRIC)  # one row per model
    best = evaluate.leaderboard(metric, "model", "rmse", "registry_pos").where("rank = 1").first()
    numbers = ["rmse", "mae", "r2", "cv_rmse", "cv_std", "skill_vs_baseline"]
    metric = metric.withColumns({c: round_half_even(c, 4) for c in numbers}).withColumn("run_id", run_id)
    importance = importance_shares(spark.createDataFrame(weights, "model string, feature string, weight double"))
    run = spark.createDataFrame([(best["model"], round(best["rmse"], 4), round(float(base["rmse"]), 4), round(float(base["mae"]), 4), feats, prep.n_no_group)],
                                "best_model string, best_rmse double, baseline_rmse double, baseline_mae double, "
                                "feature_names array<string>, n_rows_without_group long").withColumn("run_id", run_id)
    return RunResult(run.first()["run_id"], best["model"], PipelineModel(stages=[prep.scaler, prep.assembler, fitted[best["model"]]]),
                     run, metric, importance.withColumn("run_id", run_id), prep.assign.withColumn("run_id", run_id), failed)


def score(pipeline: PipelineModel, df: DataFrame, out: str = "prediction_clipped") -> DataFrame:
    """Transform, then clip the prediction at 0."""
    return pipeline.transform(df).withColumn(out, F.greatest(F.col("prediction"), F.lit(0.0)))
