"""Registered queries: model training, scoring and what-if with a fitted model
(H5-H7, H10-H14, I1-I5, I8, I9, F7, F8, A9).  Fits of trees and boosters are not
SQL: tests hold them against known splits.  ``linear_cv`` holds the linear models and
their fold errors against SQL."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.functions.expressions import severity_score
from citytherm.operators import evaluate, features, learn, linear, preprocess, scoring, whatif
from citytherm.plans.common import lineitem_observations, rnd
from citytherm.plans.oracle import R
from citytherm.plans.registry import register
from citytherm.plans.scenarios import group_scenarios
from citytherm.session import shared_dir
from citytherm.sources.cities import city_frame
from citytherm.sources.stages import cached_stage, once
from citytherm.sources.tables import Tables

LABEL, GROUP = features.TARGET_COLUMN, features.GROUP_COLUMN
KEYS = ["l_orderkey", "l_linenumber"]


def _inputs(sf: str) -> list[str]:
    return [f"{sf}/{t}.parquet" for t in ("lineitem", "supplier", "nation")]


def feature_table(spark: SparkSession, sf: str) -> preprocess.Prepared:
    """The processed stage table: built once per application and state of the
    inputs, written to the shared folder and read back by every fit, fold and
    score (the reference hands over a processed file between stages too)."""
    def build():
        return preprocess.preprocess(lineitem_observations(spark, Tables(spark, sf)), keep=KEYS).table
    table = cached_stage(spark, build, "processed", sf, inputs=_inputs(sf))
    return preprocess.Prepared(table, None, features.feature_list(table))


def _grid_frame(spark, cand, avg, std) -> DataFrame:
    rows = [({k: str(v) for k, v in d.items()}, float(a), None if s is None else float(s))
            for d, a, s in zip(cand.grid_desc, avg, std)]
    return spark.createDataFrame(rows, "params map<string,string>, cv_rmse double, cv_std double")


def _grid_query(spark: SparkSession, sf: str, model: str, profile: str) -> DataFrame:
    ft = feature_table(spark, sf)
    prep = learn.prepare(ft.table, ft.feature_names, LABEL, GROUP)
    cand = next(c for c in learn.build_candidates(profile) if c.name == model)
    _, avg, std = learn.grid_cv(prep, cand)
    out = _grid_frame(spark, cand, avg, std).withColumn("model", F.lit(model))
    return out


@register("ridge_path")
def q_ridge_path(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge over the full alpha grid, group-fold CV RMSE per alpha."""
    return _grid_query(spark, sf, "Ridge Regression", "full")


@register("lasso_path")
def q_lasso_path(spark: SparkSession, sf: str) -> DataFrame:
    """Lasso over the full alpha grid, group-fold CV RMSE per alpha."""
    return _grid_query(spark, sf, "Lasso Regression", "full")


LINEAR_ALPHAS = {"ridge": [0.0, 1.0, 1e4], "lasso": [10.0, 1e3, 1e9]}

_LINEAR_SQL = f"""
WITH d AS (SELECT l_orderkey % 5 AS fold, l_quantity AS x1, l_discount * 100 AS x2, l_extendedprice AS y FROM lineitem),
  s AS (SELECT k.k, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) AS c11, covar_pop(x2, x2) AS c22,
               covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y
        FROM d JOIN (SELECT DISTINCT fold AS k FROM d) k ON d.fold <> k.k GROUP BY k.k),
  r AS (SELECT 'ridge' AS model, a AS alpha, s.*, c11 + a / n AS g11, c22 + a / n AS g22
        FROM s, (VALUES {", ".join(f"({a!r}::DOUBLE)" for a in LINEAR_ALPHAS["ridge"])}) v(a)),
  w AS (SELECT model, alpha, k, m1, m2, my, (c1y * g22 - c2y * c12) / (g11 * g22 - c12 * c12) AS w1,
               (c2y * g11 - c1y * c12) / (g11 * g22 - c12 * c12) AS w2 FROM r
        UNION ALL
        SELECT 'lasso', a, k, m1, m2, my, sign(c1y) * greatest(abs(c1y) - a, 0.0) / c11, 0.0
        FROM s, (VALUES {", ".join(f"({a!r}::DOUBLE)" for a in LINEAR_ALPHAS["lasso"])}) v(a))
SELECT model, alpha, k AS fold,
       {R('sqrt(avg((y - my - w1 * (x1 - m1) - w2 * (x2 - m2)) * (y - my - w1 * (x1 - m1) - w2 * (x2 - m2))))', 4)} AS rmse
FROM w JOIN d ON d.fold = w.k GROUP BY model, alpha, k"""


@register("linear_cv", _LINEAR_SQL)
def q_linear_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Fold errors of least squares and ridge on two features and
    lasso on one, over whole order groups, from one pass of cross-products."""
    out, _, _ = _linear_folds(spark, sf)
    return (spark.createDataFrame(out, "model string, alpha double, fold long, rmse double")
            .withColumn("rmse", rnd("rmse", 4)))


def _linear_folds(spark: SparkSession, sf: str):
    """(model, alpha, fold, rmse) rows, and the folds' statistics with two features and with one."""
    li = Tables(spark, sf).lineitem
    rows = li.select((F.col("l_orderkey") % 5).alias("fold"), F.array("l_quantity", F.col("l_discount") * 100).alias("features"),
                     F.col("l_extendedprice").alias("label"))
    both = {k: s for (k,), s in linear.statistics(rows, ["fold"]).items()}
    one = {k: linear.Statistics(s.n, s.mean[[0, 2]], s.c[np.ix_([0, 2], [0, 2])]) for k, s in both.items()}
    out = []
    for model, folds, solve in (("ridge", both, linear.ridge), ("lasso", one, linear.lasso)):
        for alpha, errors in zip(LINEAR_ALPHAS[model], linear.fold_errors(folds, solve, LINEAR_ALPHAS[model])):
            out += [(model, alpha, k, e) for k, e in zip(sorted(folds), errors)]
    return out, both, one


_SELECTED_SQL = f"""
WITH f AS ({_LINEAR_SQL}),
  b AS (SELECT model, alpha FROM f GROUP BY model, alpha ORDER BY round_even(avg(rmse), 2), model, alpha LIMIT 1),
  d AS (SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount * 100 AS x2, l_extendedprice AS y FROM lineitem),
  s AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) AS c11, covar_pop(x2, x2) AS c22,
               covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y FROM d),
  g AS (SELECT model, alpha, s.*, c11 + alpha / n AS g11, c22 + alpha / n AS g22 FROM s, b),
  w AS (SELECT *, CASE WHEN model = 'ridge' THEN (c1y * g22 - c2y * c12) / (g11 * g22 - c12 * c12) ELSE sign(c1y) * greatest(abs(c1y) - alpha, 0.0) / c11 END AS w1,
               CASE WHEN model = 'ridge' THEN (c2y * g11 - c1y * c12) / (g11 * g22 - c12 * c12) ELSE 0.0 END AS w2 FROM g)
SELECT l_orderkey, l_linenumber, model || ' ' || CAST(CAST(alpha AS BIGINT) AS VARCHAR) AS model,
       {R('greatest(my + w1 * (x1 - m1) + w2 * (x2 - m2), 0.0)', 4)} AS prediction FROM d, w"""


@register("score_selected", _SELECTED_SQL)
def q_score_selected(spark: SparkSession, sf: str) -> DataFrame:
    """Every penalty of the linear models judged by its folds' mean error,
    the best one kept as a row of the model table, every line item scored with it and clipped at 0."""
    fold_rmse, both, one = _linear_folds(spark, sf)
    models = []
    for model, folds, solve in (("ridge", both, linear.ridge), ("lasso", one, linear.lasso)):
        for alpha in LINEAR_ALPHAS[model]:
            w, b = solve(linear.merged([folds[k] for k in sorted(folds)]), alpha)
            models.append((alpha, *scoring.linear_row(model, [*w, *[0.0] * (2 - len(w))], b)))
    table = spark.createDataFrame(models, f"alpha double, {scoring.MODEL_SCHEMA}")
    errors = spark.createDataFrame(fold_rmse, "model string, alpha double, fold long, rmse double").withColumn("rmse", rnd("rmse", 4))
    mean = errors.groupBy("model", "alpha").agg(rnd(F.avg("rmse"), 2).alias("cv"))
    best = mean.orderBy("cv", "model", "alpha").limit(1).join(table, ["model", "alpha"])
    name = F.concat_ws(" ", "model", F.col("alpha").cast("long").cast("string")).alias("model")
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_discount") * 100).alias("discount"))
    scored = scoring.predict(li, ["l_quantity", "discount"], best.withColumn("model", name), keep=["model"])
    return scored.select("l_orderkey", "l_linenumber", "model", rnd(F.greatest("prediction", F.lit(0.0)), 4).alias("prediction"))


@register("tree_cv")
def q_tree_cv(spark: SparkSession, sf: str) -> DataFrame:
    """H5d/H6: decision tree over the fast-profile grid, group-fold CV RMSE."""
    return _grid_query(spark, sf, "Decision Tree", "fast")


def _importance_query(spark: SparkSession, sf: str, model: str) -> DataFrame:
    ft = feature_table(spark, sf)
    prep = learn.prepare(ft.table, ft.feature_names, LABEL, GROUP)
    cand = next(c for c in learn.build_candidates("fast") if c.name == model)
    fitted = cand.fit(prep.train, {**cand.grid_desc[0], **learn.FAST_BASE[model]}, prep.n_train, prep.label_std)
    weights = spark.createDataFrame([(model, f, w) for f, w in learn.feature_weights(fitted, ft.feature_names)],
                                    "model string, feature string, weight double")
    return evaluate.top_importances(learn.importance_shares(weights).drop("model"), 15)


@register("forest_importance")
def q_forest_importance(spark: SparkSession, sf: str) -> DataFrame:
    """H5e/H11/F8: random forest (fast-profile base settings) on the training
    groups; importances normalised, top 15 flagged against their median."""
    return _importance_query(spark, sf, "Random Forest")


@register("booster_importance")
def q_booster_importance(spark: SparkSession, sf: str) -> DataFrame:
    """H5g/H11/F8: a booster profile (fast-profile base settings), its top 15."""
    return _importance_query(spark, sf, "Boosting A")


@register("run_report")
def q_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """H2-H14 end to end on the fast profile's linear and tree models: split,
    baseline, grid search, outer CV, metrics, skill, best model.  Trains whenever it
    is called; the run and its best pipeline are recorded for the scoring queries."""
    _, path = _trained(spark, sf, force=True)
    run = spark.read.parquet(f"{path}/run").select("run_id", "best_model", "best_rmse", "baseline_rmse")
    return spark.read.parquet(f"{path}/metric").join(run, "run_id")


SCORED_MODELS = ["Linear Regression", "Ridge Regression", "Decision Tree"]


def _trained(spark: SparkSession, sf: str, force: bool = False):
    """Feature table and the folder of the latest run for the present inputs (A9/A10):
    metrics, run row and the best pipeline by test error."""
    ft = feature_table(spark, sf)

    def build(path: str) -> None:
        res = learn.train_models(ft.table, ft.feature_names, LABEL, GROUP, profile="fast", models=SCORED_MODELS)
        res.best_pipeline.save(f"{path}/model")
        res.model_metric.write.parquet(f"{path}/metric")
        res.run.write.parquet(f"{path}/run")
    return ft, once(spark, build, "run", sf, inputs=_inputs(sf), force=force)


def _fitted(spark: SparkSession, sf: str):
    """Feature table, the pipeline of the latest run's best model, and the baseline RMSE."""
    ft, path = _trained(spark, sf)
    return ft, PipelineModel.load(f"{path}/model"), float(spark.read.parquet(f"{path}/run").first()["baseline_rmse"])


@register("score_batch")
def q_score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Score every feature row in one batch, clip at 0, severity."""
    ft, pipe, _ = _fitted(spark, sf)
    s = learn.score(pipe, ft.table)
    return s.select(*KEYS, GROUP, LABEL, "prediction_clipped",
                    severity_score("prediction_clipped").alias("severity"))


@register("scenario_score")
def q_scenario_score(spark: SparkSession, sf: str) -> DataFrame:
    """One scenario per city scored, severity, delta vs the
    baseline RMSE, nearest city profile and the gap to its mean target."""
    ft, pipe, base_rmse = _fitted(spark, sf)
    scen = whatif.preset_from_city(group_scenarios(spark, Tables(spark, sf)), city_frame(spark))
    scored = whatif.score_scenarios(pipe, scen, baseline_rmse=base_rmse)
    # city profiles: mean feature row per city, scaled with the same stage
    prof = ft.table.groupBy(GROUP).agg(*[F.avg(c).alias(c) for c in ft.feature_names],
                                       F.avg(LABEL).alias("city_mean_target"))
    pv = pipe.stages[1].transform(pipe.stages[0].transform(prof))
    pv = pv.select(GROUP, "city_mean_target", vector_to_array("features").alias("v"))
    sv = scored.select("scenario_id", "uhi_pred", "severity", "delta_vs_baseline",
                       vector_to_array("features").alias("v"))
    # predictions and mean targets travel with the match: scored and profiled once
    near = whatif.nearest_profiles(sv, pv, "scenario_id", "v", GROUP, "v",
                                   carry=["uhi_pred", "severity", "delta_vs_baseline"], profile_carry=["city_mean_target"])
    return (near.where(F.col("rank") == 1)
            .select("scenario_id", "uhi_pred", "severity", "delta_vs_baseline", F.col(GROUP).alias("closest_city"), "similarity",
                    "city_mean_target", (F.col("uhi_pred") - F.col("city_mean_target")).alias("gap_to_closest")))


@register("contributions")
def q_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """The 12 largest scaled features of every feature row."""
    ft, pipe, _ = _fitted(spark, sf)
    scaled = pipe.stages[1].transform(pipe.stages[0].transform(ft.table))
    scaled = scaled.withColumn("row_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return whatif.contributions(scaled, ft.feature_names, key="row_id")


SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("contribution_rank", f"""
WITH s AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(SCALED))} FROM lineitem),
  b AS (SELECT *, row_number() OVER () AS rid FROM lineitem),
  z AS ({" UNION ALL ".join(f"SELECT rid, l_orderkey * 8 + l_linenumber AS row_id, '{c}' AS feature, ({c} - m{i}) / s{i} AS value FROM b, s" for i, c in enumerate(SCALED))}),
  r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(value) DESC, feature) AS rank,
               max(abs(value)) OVER (PARTITION BY rid) AS largest FROM z)
SELECT row_id, CAST(rank AS INTEGER) AS rank, feature, {R('value')} AS value, {R('abs(value) / largest')} AS width FROM r WHERE rank <= 3""")
def q_contribution_rank(spark: SparkSession, sf: str) -> DataFrame:
    """The 3 largest scaled measures of every line item, with their width."""
    li = Tables(spark, sf).lineitem.withColumn("row_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    scaled = learn.standardize(li.select("row_id", *SCALED), SCALED)
    out = whatif.contributions(scaled.select("row_id", F.array(*SCALED).alias("z")), SCALED, key="row_id", vector_col="z", k=3)
    return out.withColumns({"value": rnd("value"), "width": rnd("width")})


@register("importance_share", f"""
WITH w AS (SELECT l_returnflag AS model, CAST(l_suppkey AS VARCHAR) AS feature, sum(CAST(l_quantity AS BIGINT) * (l_linenumber - 4)) AS weight
           FROM lineitem GROUP BY 1, 2),
  i AS (SELECT model, feature, {R('abs(weight) / (sum(abs(weight)) OVER (PARTITION BY model) + 1e-9)', 5)} AS importance FROM w),
  t AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rank FROM i),
  k AS (SELECT model, median(importance) AS med FROM t WHERE rank <= 15 GROUP BY model)
SELECT t.model, t.feature, t.importance, CAST(t.rank AS INTEGER) AS rank, t.importance > k.med AS above_median
FROM t JOIN k ON t.model = k.model WHERE t.rank <= 15""")
def q_importance_share(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of a table normalised per model, the 15 largest flagged
    against their median (weights: a signed measure per return flag and supplier)."""
    li = Tables(spark, sf).lineitem
    weights = li.groupBy(F.col("l_returnflag").alias("model"), F.col("l_suppkey").cast("string").alias("feature")).agg(
        F.sum(F.col("l_quantity").cast("long") * (F.col("l_linenumber") - 4)).cast("double").alias("weight"))
    return evaluate.top_importances(learn.importance_shares(weights), 15, "model")


@register("sensitivity")
def q_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    """Every city scenario at 60 even values of each of the 7 parameters,
    scored in one batch."""
    ft, pipe, _ = _fitted(spark, sf)
    scen = group_scenarios(spark, Tables(spark, sf))
    s = whatif.score_scenarios(pipe, whatif.sweep(scen))
    return s.select("scenario_id", "vary", "point", F.col("uhi_pred"))


@register("response_surface")
def q_response_surface(spark: SparkSession, sf: str) -> DataFrame:
    """I4: every city scenario over the 35 x 35 temperature x urban-fraction grid."""
    ft, pipe, _ = _fitted(spark, sf)
    scen = group_scenarios(spark, Tables(spark, sf))
    s = whatif.score_scenarios(pipe, whatif.response_grid(scen))
    return s.select("scenario_id", "gi", "gj", "temp", "uf", "uhi_pred")


@register("model_roundtrip", """
SELECT count(*) AS n_rows, 0.0::DOUBLE AS max_abs_diff FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_returnflag <> 'R' AND (l.l_quantity - 10.0) * 1.5 BETWEEN -60 AND 60 AND l.l_discount * 1100.0 BETWEEN 0 AND 100""")
def q_model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Save the fitted pipeline to the shared folder, load it, score with
    both; report rows and the largest prediction difference (0 expected)."""
    ft, pipe, _ = _fitted(spark, sf)
    path = shared_dir(spark, "model")
    pipe.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    once_scored = pipe.transform(ft.table).select(*ft.table.columns, F.col("prediction").alias("p1"))
    both = loaded.transform(once_scored)  # one frame, row by row
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("p1") - F.col("prediction"))).alias("max_abs_diff"))
