"""Evaluation: metrics, baseline, skill, residual analysis, model comparison
(H4, H8, H9, E25-E27, B17, F3, F4, F8, I10)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citytherm.functions.expressions import (minmax_normalise, round_half_even,
                                             sample_excess_kurtosis, sample_skewness)
from citytherm.functions.stats import global_median, scalars
from citytherm.sources.stages import materialize


def regression_metrics(df: DataFrame, label: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R^2 (1 - SSres/SStot about the label's own mean), n.

    One pass of sums per key: SStot = sum(y^2) - (sum y)^2 / n.  A second
    pass for the mean would join the (often deep) prediction plan to itself.
    """
    ks = list(keys)
    y, p = F.col(label), F.col(pred)
    err = y - p
    agg = df.groupBy(*ks).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_ssr"),
        F.sum(y).alias("_sy"), F.sum(y * y).alias("_syy"),
        F.count(F.lit(1)).alias("n"))
    sst = F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("n")
    r2 = F.when(sst > 0, F.lit(1.0) - F.col("_ssr") / sst).otherwise(
        F.when(F.col("_ssr") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return agg.select(*ks, "rmse", "mae", r2.alias("r2"), "n")


def baseline_predictions(train: DataFrame, test: DataFrame, label: str, out: str = "pred") -> DataFrame:
    """H4: every test row predicted by the training mean (a scalar subquery)."""
    m = scalars(train.agg(F.avg(label).alias(out)))
    return test.withColumn(out, m(out))


def skill(rmse, baseline_rmse, digits: int | None = 4):
    """H9: 1 - rmse / (baseline + 1e-9)."""
    s = F.lit(1.0) - rmse / (baseline_rmse + F.lit(1e-9))
    return round_half_even(s, digits) if digits is not None else s


def residual_moments(df: DataFrame, residual: str) -> DataFrame:
    """Mean, population std, MAE, RMSE, corrected skewness and excess kurtosis."""
    r = F.col(residual)
    return df.agg(F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"),
                  F.avg(F.abs(r)).alias("mae"), F.sqrt(F.avg(r * r)).alias("rmse"),
                  sample_skewness(r).alias("skewness"), sample_excess_kurtosis(r).alias("kurtosis"),
                  F.count(r).alias("n"))


def group_error(df: DataFrame, group: str, residual: str) -> DataFrame:
    """MAE per group and whether it is below the median group's MAE."""
    per = materialize(df.where(F.col(group).isNotNull())  # one row per group, read by the median and the result
                      .groupBy(group).agg(F.avg(F.abs(F.col(residual))).alias("mae")), "group-error")
    med = scalars(global_median(per, "mae", "_med"))("_med")  # one value
    return per.withColumn("below_median", F.col("mae") < med)


def normal_curve(df: DataFrame, residual: str, points: int = 200, bins: int = 40) -> DataFrame:
    """Normal density with the residuals' mean and population std on an
    even grid over [min, max], scaled to histogram counts (n * range / bins)."""
    r = F.col(residual)
    m = df.agg(F.min(r).alias("_lo"), F.max(r).alias("_hi"), F.avg(r).alias("_mu"),
               F.stddev_pop(r).alias("_sd"), F.count(r).alias("_n"))
    g = m.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.col("_lo") + F.col("i") * (F.col("_hi") - F.col("_lo")) / F.lit(float(points - 1))
    z = (F.col("x") - F.col("_mu")) / F.col("_sd")
    pdf = F.exp(F.lit(-0.5) * z * z) / (F.col("_sd") * F.lit(math.sqrt(2.0 * math.pi)))
    scale = F.col("_n") * (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return g.withColumn("x", x).select("i", "x", (pdf * scale).alias("density"))


# --------------------------------------------------------------------------
# Model comparison over a metric table (one row per model)
# --------------------------------------------------------------------------
def comparison_scores(metrics: DataFrame, name: str = "model") -> DataFrame:
    """Five 0..1 axes, higher is better: RMSE and MAE inverted, R^2 and
    skill floored at 0, stability 1/(cv_std + 0.01)."""
    m = metrics.select(name, "rmse", "mae",
                       F.greatest(F.col("r2"), F.lit(0.0)).alias("_r2"),
                       F.greatest(F.coalesce(F.col("skill"), F.lit(0.0)), F.lit(0.0)).alias("_sk"),
                       (F.lit(1.0) / (F.col("cv_std") + F.lit(0.01))).alias("_st"))
    axes = ["rmse", "mae", "_r2", "_sk", "_st"]
    rng = scalars(m.agg(*[F.min(a).alias(f"{a}__lo") for a in axes],
                        *[F.max(a).alias(f"{a}__hi") for a in axes]))
    norm = lambda a, inv=False: minmax_normalise(a, rng(f"{a}__lo"), rng(f"{a}__hi"), invert=inv)
    return m.select(name, norm("rmse", True).alias("rmse_inv"), norm("mae", True).alias("mae_inv"),
                    norm("_r2").alias("r2"), norm("_sk").alias("skill"), norm("_st").alias("stability"))


def leaderboard(metrics: DataFrame, name: str = "model", order: str = "rmse",
                registry_pos: str | None = None) -> DataFrame:
    """Rank models by a metric (ties: registry position, then name).

    The metric table has one row per model, so a global window is cheap.
    """
    keys = [F.col(order).asc_nulls_last()]
    if registry_pos is not None:
        keys.append(F.col(registry_pos))
    keys.append(F.col(name))
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy(*keys)))


def top_importances(imp: DataFrame, k: int = 15, model_col: str | None = None) -> DataFrame:
    """F8: k largest importances (per model) and whether each is above the
    median of those k."""
    part = [model_col] if model_col else []
    w = Window.partitionBy(*part).orderBy(F.col("importance").desc(), F.col("feature"))
    top = imp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    if part:
        med = top.groupBy(*part).agg(F.median("importance").alias("_med"))
        j = top.join(F.broadcast(med), part)  # one row per model
        return j.withColumn("above_median", F.col("importance") > F.col("_med")).drop("_med")
    med = scalars(top.agg(F.median("importance").alias("_med")))("_med")
    return top.withColumn("above_median", F.col("importance") > med)
