"""Profiling questions over an observation table.

Everything aggregates first and ranks after, so no window ever spans a whole
table of raw rows.  One-row statistics (min/max, medians, fences) are kept in
the plan and broadcast; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citytherm.functions.expressions import MONTH_NAMES, month_name
from citytherm.functions.moments import co_moments
from citytherm.functions.stats import quantiles, scalars, wide_quantiles


def _cols(cs):
    return [cs] if isinstance(cs, str) else list(cs)


# --------------------------------------------------------------------------
# Group summaries
# --------------------------------------------------------------------------
def group_ranking(df: DataFrame, group: str | Sequence[str], value: str) -> DataFrame:
    """Mean, sample std, min, max per group."""
    return (df.groupBy(*_cols(group))
            .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                 F.min(value).alias("min"), F.max(value).alias("max"),
                 F.count(value).alias("n")))


def group_mean(df: DataFrame, group: str | Sequence[str], value: str, out: str = "mean") -> DataFrame:
    """Mean of ``value`` per group columns."""
    return df.groupBy(*_cols(group)).agg(F.avg(value).alias(out))


def daily_mean(df: DataFrame, group: str, ts: str, value: str) -> DataFrame:
    """Mean per (group, calendar day)."""
    return (df.groupBy(group, F.to_date(ts).alias("date"))
            .agg(F.avg(value).alias("mean")))


def monthly_mean(df: DataFrame, group: str, month: Column | str, value: str) -> DataFrame:
    """Mean per (group, month) plus the month's short name."""
    m = F.col(month) if isinstance(month, str) else month
    return (df.groupBy(group, m.alias("month")).agg(F.avg(value).alias("mean"))
              .withColumn("month_name", month_name("month")))


def pivot_month(df: DataFrame, group: str, month: Column | str, value: str,
                months: Sequence[int] | str | None = None, fill: float = 0.0) -> DataFrame:
    """Group x month mean, one column per month name, empty cell -> ``fill``.

    Months default to 1..12 so the schema is fixed and Spark needs no extra
    job to discover pivot values; ``months="present"`` keeps only the months
    that occur (as the reference does), found by one small distinct job
    (at most 12 values).
    """
    m = F.col(month) if isinstance(month, str) else month
    if months == "present":
        months = sorted(r[0] for r in df.select(m.alias("_m")).where(F.col("_m").isNotNull())
                        .distinct().collect())
    months = list(months or range(1, 13))
    p = df.withColumn("_month", m).groupBy(group).pivot("_month", months).agg(F.avg(value))
    renamed = p.select(group, *[F.col(str(k)).alias(MONTH_NAMES[k - 1]) for k in months])
    return renamed.na.fill(fill, subset=[MONTH_NAMES[k - 1] for k in months])


def first_and_mean(df: DataFrame, group: str, coords: Sequence[str], value: str) -> DataFrame:
    """Per group, deterministic coordinates (min) and the mean value."""
    return (df.groupBy(group)
            .agg(*[F.min(c).alias(c) for c in coords], F.avg(value).alias("mean")))


# --------------------------------------------------------------------------
# Table-level facts
# --------------------------------------------------------------------------
def table_profile(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows, columns, distinct keys, span in whole elapsed days.

    ``count_distinct`` is exact (a shuffle on the key); the span is the
    elapsed time floored to days, as a timedelta's ``days`` is.
    """
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).alias("n_columns"),
                  F.count_distinct(key).alias("n_keys"),
                  F.timestamp_diff("DAY", F.min(ts), F.max(ts)).alias("span_days"))


def null_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Null count per column, long form, columns with > 0 nulls only."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = wide.selectExpr(f"stack({len(df.columns)}, {pairs}) as (column_name, n_null)")
    return long.where(F.col("n_null") > 0) if only_positive else long


def shape_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before and after a step."""
    b = before.agg(F.lit("before").alias("stage"), F.count(F.lit(1)).alias("n_rows"),
                   F.lit(len(before.columns)).alias("n_columns"))
    a = after.agg(F.lit("after").alias("stage"), F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(after.columns)).alias("n_columns"))
    return b.unionByName(a)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def headline(df: DataFrame, group: str, value: str) -> DataFrame:
    """Overall mean/max, top group by mean and its mean, row count."""
    per = df.groupBy(group).agg(F.avg(value).alias("_gm"))
    top = scalars(per.agg(F.max_by(F.col(group), F.struct(F.col("_gm"), F.col(group))).alias("top_group"),
                          F.max("_gm").alias("top_group_mean")))
    return df.agg(F.avg(value).alias("mean"), F.max(value).alias("max"),
                  F.count(F.lit(1)).alias("n_rows"),
                  F.first(top("top_group")).alias("top_group"),
                  F.first(top("top_group_mean")).alias("top_group_mean"))


# --------------------------------------------------------------------------
# Correlation and least squares
# --------------------------------------------------------------------------
def _pearson():
    spread = F.sqrt(F.col("c_ii")) * F.sqrt(F.col("c_jj"))
    return F.when(spread > 0, F.greatest(F.least(F.col("c_ij") / spread, F.lit(1.0)), F.lit(-1.0))).alias("r")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every ordered pair, long form; null
    where a column of the pair is constant or the pair has no rows.

    One pass adds up the co-moments of all pairs as matrices, whatever their number.
    """
    names = F.array(*[F.lit(c) for c in cols])
    pairs = co_moments(df, cols).where("i < j").select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), _pearson())
    both = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b"), "r"),
                                         F.struct(F.col("b").alias("col_a"), F.col("a").alias("col_b"), "r"))))
    own = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    return both.unionByName(own)


def corr_with_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """R of each feature with the target, with rank by |r| (1 = strongest)."""
    names = F.array(*[F.lit(f) for f in features])
    found = co_moments(df, [*features, target]).where((F.col("j") == len(features)) & (F.col("i") < len(features)))
    long = found.select(F.get(names, "i").alias("feature"), _pearson())
    w = Window.orderBy(F.abs(F.col("r")).desc_nulls_last(), F.col("feature"))
    return long.withColumn("abs_rank", F.row_number().over(w))  # p rows only


def ols_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept, r and r^2 of y ~ x."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.corr(y, x).alias("r"), F.regr_r2(y, x).alias("r2"),
                  F.regr_count(y, x).alias("n"))


# --------------------------------------------------------------------------
# Distributions
# --------------------------------------------------------------------------
def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls into the last bin;
    empty bins are present with count 0.
    """
    v = F.col(value)
    rng = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    r = scalars(rng)
    lo, hi = r("_lo"), r("_hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi > lo, F.least(F.floor((v - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = (df.where(v.isNotNull())
                .groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    edges = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_hi")
    w2 = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return (edges.join(counts, "bin", "left")  # bins x bins rows
            .select("bin", (F.col("_lo") + F.col("bin") * w2).alias("lower"),
                    (F.col("_lo") + (F.col("bin") + 1) * w2).alias("upper"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def box_summary(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """Quartiles, fences, whiskers (extreme values inside the fences),
    outlier count, mean, sample sd.  Quartiles come from the two-phase exact
    quantiles (a scalar subquery); moments and whiskers are one more pass.
    """
    v = F.col(value)
    qs = scalars(wide_quantiles(df, [value], [0.25, 0.5, 0.75], ["q1", "median", "q3"]))
    q1, med, q3 = qs(f"{value}__q1"), qs(f"{value}__median"), qs(f"{value}__q3")
    lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    inside = v.between(lo, hi)
    return df.agg(F.first(q1).alias("q1"), F.first(med).alias("median"), F.first(q3).alias("q3"),
                  F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.count(v).alias("n"),
                  F.first(lo).alias("lower_fence"), F.first(hi).alias("upper_fence"),
                  F.min(F.when(inside, v)).alias("whisker_low"),
                  F.max(F.when(inside, v)).alias("whisker_high"),
                  F.count_if(v.isNotNull() & ~inside).alias("n_outliers"))


def top_groups_distribution(df: DataFrame, group: str, value: str, k: int = 8) -> DataFrame:
    """The k groups with the highest mean, and their quartiles.

    Top-k is a ``TakeOrderedAndProject`` over the group means; the quartiles
    of those groups use the two-phase exact quantiles, so a hot group is
    spread over reducers by value.
    """
    means = df.groupBy(group).agg(F.avg(value).alias("mean"))
    top = means.orderBy(F.col("mean").desc(), F.col(group)).limit(k)
    sub = df.join(F.broadcast(top.select(group)), group, "left_semi")  # k keys
    ext = sub.groupBy(group).agg(F.min(value).alias("min"), F.max(value).alias("max"),
                                 F.count(value).alias("n"))
    qs = quantiles(sub, [value], [0.25, 0.5, 0.75], keys=group).drop("column_name")
    return (ext.join(qs, group).join(F.broadcast(top), group)
            .select(group, "mean", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                    F.col("q")[2].alias("q3"), "max", "n"))


# --------------------------------------------------------------------------
# Ordering, limits, sampling
# --------------------------------------------------------------------------
def top_bottom(agg: DataFrame, key: str, measure: str, k: int = 10) -> DataFrame:
    """k highest and k lowest rows of an aggregate, tagged."""
    top = agg.orderBy(F.col(measure).desc(), F.col(key)).limit(k).withColumn("side", F.lit("top"))
    bot = agg.orderBy(F.col(measure).asc(), F.col(key)).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bot)


def preview(df: DataFrame, order: Sequence[str], n: int = 300) -> DataFrame:
    """first n rows under an explicit order (top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """a repeatable sample of exactly min(n, rows) rows: order by md5(seed||key)."""
    h = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def default_keys(df: DataFrame, key: str, n: int = 6) -> DataFrame:
    """Sorted distinct keys, first n."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)
