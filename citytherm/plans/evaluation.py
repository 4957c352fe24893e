"""Registered queries: splits, baseline and metrics, standardisation,
residual analysis, model comparison (H1-H4, H8, H9, E25-E27, B17, F3, F4, I10)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citytherm.functions.stats import scalars
from citytherm.operators import evaluate, split
from citytherm.plans.cleaning import R
from citytherm.plans.common import rnd, round_doubles
from citytherm.plans.registry import register
from citytherm.sources.tables import Tables

SEED = 42


def _orders_grouped(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


ORDERS_GROUPED_SQL = """
  og AS (SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_nationkey
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

SPLIT_SQL = ORDERS_GROUPED_SQL + f""",
  gc AS (SELECT c_nationkey, count(*) AS n_rows FROM og WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey),
  gr AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}' || CAST(c_nationkey AS VARCHAR)), c_nationkey) AS pos,
                count(*) OVER () AS g FROM gc),
  sp AS (SELECT c_nationkey, n_rows, CASE WHEN pos <= ceil(g * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
         FROM gr)"""


@register("group_split", f"WITH {SPLIT_SQL} SELECT * FROM sp")
def q_group_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.group_holdout(_orders_grouped(Tables(spark, sf)), "c_nationkey", 0.2, SEED)


@register("group_folds", f"""
WITH RECURSIVE {ORDERS_GROUPED_SQL},
  gc AS (SELECT c_nationkey, count(*) AS n_rows FROM og WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey),
  r AS (SELECT *, row_number() OVER (ORDER BY n_rows DESC, md5('{SEED}' || CAST(c_nationkey AS VARCHAR)), c_nationkey) AS i FROM gc),
  d(i, l0, l1, l2, l3, l4, fold) AS (
    SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, -1
    UNION ALL
    SELECT i, l0 + CASE WHEN f = 0 THEN n_rows ELSE 0 END, l1 + CASE WHEN f = 1 THEN n_rows ELSE 0 END,
           l2 + CASE WHEN f = 2 THEN n_rows ELSE 0 END, l3 + CASE WHEN f = 3 THEN n_rows ELSE 0 END,
           l4 + CASE WHEN f = 4 THEN n_rows ELSE 0 END, f
    FROM (SELECT r.i, r.n_rows, l0, l1, l2, l3, l4,
                 CASE least(l0, l1, l2, l3, l4) WHEN l0 THEN 0 WHEN l1 THEN 1 WHEN l2 THEN 2 WHEN l3 THEN 3 ELSE 4 END AS f
          FROM d JOIN r ON r.i = d.i + 1))
SELECT r.c_nationkey, r.n_rows, d.fold FROM d JOIN r ON r.i = d.i""")
def q_group_folds(spark: SparkSession, sf: str) -> DataFrame:
    return split.group_folds(_orders_grouped(Tables(spark, sf)), "c_nationkey", 5)


@register("baseline_metrics", f"""
WITH {SPLIT_SQL},
  q AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey),
  d AS (SELECT og.*, q.qty, sp.split FROM og JOIN sp ON og.c_nationkey = sp.c_nationkey
        JOIN q ON og.o_orderkey = q.l_orderkey),
  fit AS (SELECT avg(o_totalprice) AS ybar, regr_slope(o_totalprice, qty) AS b,
                 regr_intercept(o_totalprice, qty) AS a FROM d WHERE split = 'train'),
  p AS (SELECT 'baseline' AS model, o_totalprice AS y, ybar AS pred FROM d, fit WHERE split = 'test'
        UNION ALL
        SELECT 'ols_quantity', o_totalprice, a + b * qty FROM d, fit WHERE split = 'test'),
  tm AS (SELECT model, avg(y) AS ym FROM p GROUP BY model),
  m AS (SELECT p.model, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
               1.0::DOUBLE - sum((y - pred) * (y - pred)) / sum((y - ym) * (y - ym)) AS r2, count(*) AS n
        FROM p JOIN tm ON p.model = tm.model GROUP BY p.model)
SELECT m.model, {R('m.rmse')} AS rmse, {R('m.mae')} AS mae, {R('m.r2')} AS r2,
       {R('1.0::DOUBLE - m.rmse / (b.rmse + 1e-9)', 4)} AS skill, m.n
FROM m, (SELECT rmse FROM m WHERE model = 'baseline') b""")
def q_baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """H2 split -> H4 baseline and a one-feature least-squares model -> H8, H9."""
    t = Tables(spark, sf)
    og = _orders_grouped(t)
    sp = split.group_holdout(og, "c_nationkey", 0.2, SEED)
    qty = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    d = (split.attach(og, sp, "c_nationkey")
         .join(qty, F.col("o_orderkey") == F.col("l_orderkey")))
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    fit = scalars(train.agg(F.avg("o_totalprice").alias("ybar"),
                            F.regr_slope("o_totalprice", "qty").alias("b"),
                            F.regr_intercept("o_totalprice", "qty").alias("a")))
    # both predictors in one pass over the test rows (no union of two plans)
    preds = test.select(F.col("o_totalprice").alias("y"), F.inline(F.array(
        F.struct(F.lit("baseline").alias("model"), fit("ybar").alias("pred")),
        F.struct(F.lit("ols_quantity").alias("model"), (fit("a") + fit("b") * F.col("qty")).alias("pred")))))
    m = evaluate.regression_metrics(preds, "y", "pred", ["model"])
    # the baseline RMSE is read across the two-row metric table by a window
    base = F.max(F.when(F.col("model") == "baseline", F.col("rmse"))).over(Window.partitionBy())
    out = m.withColumn("skill", evaluate.skill(F.col("rmse"), base))
    return out.select("model", *[rnd(c).alias(c) for c in ("rmse", "mae", "r2")], "skill", "n")


# --------------------------------------------------------------------------
# H1
# --------------------------------------------------------------------------
STD_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "c_const"]


@register("standardize", f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                   1.0::DOUBLE AS c_const FROM lineitem),
  s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in STD_COLS)} FROM li)
SELECT l_orderkey, l_linenumber,
  {', '.join(R(f'CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END') + f' AS z_{c}' for c in STD_COLS)}
FROM li, s""")
def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    from citytherm.operators.learn import standardize
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                           "l_discount", "l_tax").withColumn("c_const", F.lit(1.0))
    z = standardize(li, STD_COLS, prefix="z_")
    return round_doubles(z.select("l_orderkey", "l_linenumber", *[f"z_{c}" for c in STD_COLS]))


# --------------------------------------------------------------------------
# E25 - E27 on residual = value - user mean
# --------------------------------------------------------------------------
def _residuals(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "value")
    m = e.groupBy("user_id").agg(F.avg("value").alias("_m"))
    return e.join(m, "user_id").withColumn("residual", F.col("value") - F.col("_m")).drop("_m")


RESID_SQL = """
  rm AS (SELECT user_id, avg(value) AS m FROM events GROUP BY user_id),
  rs AS (SELECT e.event_id, e.user_id, e.value - rm.m AS residual FROM events e JOIN rm ON e.user_id = rm.user_id)"""


@register("residual_moments", f"""
WITH {RESID_SQL}
SELECT {R('avg(residual)')} AS mean, {R('stddev_pop(residual)')} AS std, {R('avg(abs(residual))')} AS mae,
       {R('sqrt(avg(residual * residual))')} AS rmse, {R('skewness(residual)')} AS skewness,
       {R('kurtosis(residual)')} AS kurtosis, count(residual) AS n
FROM rs""")
def q_residual_moments(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(evaluate.residual_moments(_residuals(Tables(spark, sf)), "residual"))


@register("group_error", f"""
WITH {RESID_SQL},
  per AS (SELECT user_id, avg(abs(residual)) AS mae FROM rs WHERE user_id IS NOT NULL GROUP BY user_id),
  md AS (SELECT median(mae) AS med FROM per)
SELECT user_id, {R('mae')} AS mae, mae < med AS below_median FROM per, md""")
def q_group_error(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(evaluate.group_error(_residuals(Tables(spark, sf)), "user_id", "residual"))


@register("normal_curve", f"""
WITH {RESID_SQL},
  m AS (SELECT min(residual) AS lo, max(residual) AS hi, avg(residual) AS mu,
               stddev_pop(residual) AS sd, count(residual) AS n FROM rs),
  g AS (SELECT CAST(range AS INTEGER) AS i, m.* FROM range(200), m),
  x AS (SELECT i, lo + i * (hi - lo) / 199.0::DOUBLE AS x, mu, sd, n, lo, hi FROM g)
SELECT i, {R('x')} AS x,
       {R(f'exp(-0.5::DOUBLE * ((x - mu) / sd) * ((x - mu) / sd)) / (sd * {math.sqrt(2.0 * math.pi)!r}) * (n * (hi - lo) / 40.0::DOUBLE)')} AS density
FROM x""")
def q_normal_curve(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(evaluate.normal_curve(_residuals(Tables(spark, sf)), "residual"))


# --------------------------------------------------------------------------
# A metric table derived from the data: each event type is a "model" whose
# prediction is the user's mean value; cv_std is the population std of the
# per-day RMSE; skill is against the type's global-mean predictor.
# --------------------------------------------------------------------------
def _type_metrics(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_type", "value", F.to_date("ts").alias("day"))
    um = e.groupBy("user_id").agg(F.avg("value").alias("pred"))
    d = e.join(um, "user_id")
    m = evaluate.regression_metrics(d.withColumnRenamed("event_type", "model"), "value", "pred", ["model"])
    daily = (d.groupBy("event_type", "day")
              .agg(F.sqrt(F.avg((F.col("value") - F.col("pred")) ** 2)).alias("_r"))
              .groupBy(F.col("event_type").alias("model")).agg(F.stddev_pop("_r").alias("cv_std")))
    tm = e.groupBy("event_type").agg(F.avg("value").alias("_gm"))
    base = (e.join(tm, "event_type")
              .groupBy(F.col("event_type").alias("model"))
              .agg(F.sqrt(F.avg((F.col("value") - F.col("_gm")) ** 2)).alias("_b")))
    return (m.join(daily, "model").join(base, "model")
             .withColumn("skill", evaluate.skill(F.col("rmse"), F.col("_b"), None)).drop("_b"))


TYPE_METRICS_SQL = """
  ev AS (SELECT user_id, event_type, value, CAST(ts AS DATE) AS day FROM events),
  um AS (SELECT user_id, avg(value) AS pred FROM ev GROUP BY user_id),
  d AS (SELECT ev.*, um.pred FROM ev JOIN um ON ev.user_id = um.user_id),
  ym AS (SELECT event_type, avg(value) AS ybar FROM d GROUP BY event_type),
  mm AS (SELECT d.event_type AS model, sqrt(avg((value - pred) * (value - pred))) AS rmse,
                avg(abs(value - pred)) AS mae,
                1.0::DOUBLE - sum((value - pred) * (value - pred)) / sum((value - ybar) * (value - ybar)) AS r2,
                count(*) AS n
         FROM d JOIN ym ON d.event_type = ym.event_type GROUP BY d.event_type),
  dr AS (SELECT event_type, day, sqrt(avg((value - pred) * (value - pred))) AS r FROM d GROUP BY event_type, day),
  cv AS (SELECT event_type AS model, stddev_pop(r) AS cv_std FROM dr GROUP BY event_type),
  bs AS (SELECT ev.event_type AS model, sqrt(avg((value - ybar) * (value - ybar))) AS b
         FROM ev JOIN ym ON ev.event_type = ym.event_type GROUP BY ev.event_type),
  tmx AS (SELECT mm.*, cv.cv_std, 1.0::DOUBLE - mm.rmse / (bs.b + 1e-9) AS skill
          FROM mm JOIN cv ON mm.model = cv.model JOIN bs ON mm.model = bs.model)"""


@register("model_metrics", f"""
WITH {TYPE_METRICS_SQL}
SELECT model, {R('rmse')} AS rmse, {R('mae')} AS mae, {R('r2')} AS r2, n, {R('cv_std')} AS cv_std,
       {R('skill')} AS skill FROM tmx""")
def q_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_type_metrics(Tables(spark, sf)))


def _norm_sql(a: str, inv: bool = False) -> str:
    v = (f"CASE WHEN max({a}) OVER () > min({a}) OVER () THEN ({a} - min({a}) OVER ()) / "
         f"(max({a}) OVER () - min({a}) OVER () + 1e-9) ELSE 0.5::DOUBLE END")
    return f"1.0::DOUBLE - ({v})" if inv else v


@register("minmax_scores", f"""
WITH {TYPE_METRICS_SQL},
  s AS (SELECT model, rmse, mae, greatest(r2, 0.0::DOUBLE) AS r2p,
               greatest(coalesce(skill, 0.0::DOUBLE), 0.0::DOUBLE) AS skp,
               1.0::DOUBLE / (cv_std + 0.01::DOUBLE) AS st FROM tmx)
SELECT model, {R(_norm_sql('rmse', True))} AS rmse_inv, {R(_norm_sql('mae', True))} AS mae_inv,
       {R(_norm_sql('r2p'))} AS r2, {R(_norm_sql('skp'))} AS skill, {R(_norm_sql('st'))} AS stability
FROM s""")
def q_minmax_scores(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(evaluate.comparison_scores(_type_metrics(Tables(spark, sf))))


@register("leaderboard", f"""
WITH {TYPE_METRICS_SQL}
SELECT model, {R('rmse')} AS rmse, {R('cv_std')} AS cv_std,
       CAST(row_number() OVER (ORDER BY rmse NULLS LAST, model) AS INTEGER) AS rank,
       CAST(row_number() OVER (ORDER BY cv_std NULLS LAST, model) AS INTEGER) AS cv_rank
FROM tmx""")
def q_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    m = _type_metrics(Tables(spark, sf)).select("model", "rmse", "cv_std")
    lb = evaluate.leaderboard(m, "model", "rmse")
    lb = lb.withColumn("cv_rank", F.row_number().over(
        Window.orderBy(F.col("cv_std").asc_nulls_last(), F.col("model"))))  # one row per model
    return round_doubles(lb.select("model", "rmse", "cv_std", "rank", "cv_rank"))
