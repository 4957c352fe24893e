"""Registered queries: profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.functions import expressions as X
from citytherm.functions.stats import scalars
from citytherm.operators import align, clean, profile
from citytherm.plans.cleaning import LINE_RANGES, MONTHS_SQL, D, R
from citytherm.plans.common import (cities_values_sql, nation_cities, nation_cities_sql,
                                    round_doubles)
from citytherm.plans.oracle import MATCHED
from citytherm.plans.queries import _contrast, _matched
from citytherm.plans.registry import register
from citytherm.sources.cities import city_frame
from citytherm.sources.tables import Tables


def _orders_by_nation(spark: SparkSession, t: Tables) -> DataFrame:
    """orders with the customer's nation and its city coordinates."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey")
    nc = nation_cities(spark, t)
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
             .join(F.broadcast(nc), F.col("c_nationkey") == F.col("n_nationkey")))  # 25 rows


ORDERS_BY_NATION_SQL = f"""
  obn AS (SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate, nc.n_name, nc.city,
                 nc.lat, nc.lon
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          JOIN ({nation_cities_sql()}) nc ON c.c_nationkey = nc.n_nationkey)"""


# --------------------------------------------------------------------------
# E10 / E11 / E12 / E9 / E8
# --------------------------------------------------------------------------
@register("daily_mean", f"""
SELECT user_id, CAST(ts AS DATE) AS date, {R('avg(value)')} AS mean
FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def q_daily_mean(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.daily_mean(Tables(spark, sf).events, "user_id", "ts", "value"))


@register("monthly_mean", f"""
WITH {ORDERS_BY_NATION_SQL}
SELECT n_name, CAST(month(o_orderdate) AS INTEGER) AS month, {R('avg(o_totalprice)')} AS mean,
       {MONTHS_SQL}[CAST(month(o_orderdate) AS INTEGER)] AS month_name
FROM obn GROUP BY n_name, month(o_orderdate)""")
def q_monthly_mean(spark: SparkSession, sf: str) -> DataFrame:
    obn = _orders_by_nation(spark, Tables(spark, sf))
    return round_doubles(profile.monthly_mean(obn, "n_name", F.month("o_orderdate"), "o_totalprice"))


def _pivot_sql() -> str:
    cells = ", ".join(
        f"{R(f'coalesce(avg(CASE WHEN month(o_orderdate) = {k} THEN o_totalprice END), 0.0)')} AS {m}"
        for k, m in enumerate(X.MONTH_NAMES, start=1))
    return f"WITH {ORDERS_BY_NATION_SQL} SELECT n_name, {cells} FROM obn GROUP BY n_name"


@register("pivot_month", _pivot_sql())
def q_pivot_month(spark: SparkSession, sf: str) -> DataFrame:
    obn = _orders_by_nation(spark, Tables(spark, sf))
    return round_doubles(profile.pivot_month(obn, "n_name", F.month("o_orderdate"), "o_totalprice"))


@register("city_mean", f"""
WITH {ORDERS_BY_NATION_SQL}
SELECT n_name, lat, lon, {R('avg(o_totalprice)')} AS mean FROM obn GROUP BY n_name, lat, lon""")
def q_city_mean(spark: SparkSession, sf: str) -> DataFrame:
    obn = _orders_by_nation(spark, Tables(spark, sf))
    return round_doubles(profile.group_mean(obn, ["n_name", "lat", "lon"], "o_totalprice"))


@register("city_map", f"""
WITH {ORDERS_BY_NATION_SQL},
  agg AS (SELECT n_name, min(lat) AS lat, min(lon) AS lon, avg(o_totalprice) AS mean
          FROM obn GROUP BY n_name),
  names AS (SELECT lat, lon, city FROM (
              SELECT lat, lon, city, row_number() OVER (PARTITION BY lat, lon ORDER BY city_pos) AS rn
              FROM {cities_values_sql()}) WHERE rn = 1)
SELECT agg.n_name, agg.lat, agg.lon, {R('agg.mean')} AS mean, names.city
FROM agg LEFT JOIN names ON agg.lat = names.lat AND agg.lon = names.lon""")
def q_city_map(spark: SparkSession, sf: str) -> DataFrame:
    """E8 per-group coordinates + mean; D5 names by (lat, lon), deduplicated."""
    obn = _orders_by_nation(spark, Tables(spark, sf))
    agg = profile.first_and_mean(obn, "n_name", ["lat", "lon"], "o_totalprice")
    names = align.dedupe_first(city_frame(spark).select("lat", "lon", "city", "city_pos"),
                               ["lat", "lon"], ["city_pos"]).drop("city_pos")
    out = agg.join(F.broadcast(names), ["lat", "lon"], "left")  # 25-row city list
    return round_doubles(out.select("n_name", "lat", "lon", "mean", "city"))


# --------------------------------------------------------------------------
# E13 - E18
# --------------------------------------------------------------------------
@register("table_profile", """
SELECT count(*) AS n_rows, 6 AS n_columns, count(DISTINCT user_id) AS n_keys,
       date_sub('day', min(ts), max(ts)) AS span_days FROM events""")
def q_table_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(Tables(spark, sf).events, "user_id", "ts")


@register("null_counts", f"""
WITH {MATCHED}, c AS (
  SELECT 'event_id' AS column_name, count(*) - count(event_id) AS n_null FROM nm UNION ALL
  SELECT 'user_id', count(*) - count(user_id) FROM nm UNION ALL
  SELECT 'ts', count(*) - count(ts) FROM nm UNION ALL
  SELECT 'match_date', count(*) - count(match_date) FROM nm UNION ALL
  SELECT 'urban', count(*) - count(urban) FROM nm UNION ALL
  SELECT 'rural', count(*) - count(rural) FROM nm UNION ALL
  SELECT 'gap_days', count(*) - count(gap_days) FROM nm)
SELECT column_name, n_null FROM c WHERE n_null > 0""")
def q_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_counts(_matched(Tables(spark, sf)))


@register("shape_compare", f"""
SELECT 'before' AS stage, count(*) AS n_rows, 5 AS n_columns FROM lineitem
UNION ALL
SELECT 'after', count(*), 5 FROM lineitem
WHERE l_quantity BETWEEN 5 AND 45 AND l_discount BETWEEN {D(0.01)} AND {D(0.09)}
  AND l_tax BETWEEN {D(0.0)} AND {D(0.06)}""")
def q_shape_compare(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                                           "l_discount", "l_tax")
    return profile.shape_compare(li, clean.range_filter(li, LINE_RANGES))


@register("source_counts", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def q_source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(Tables(spark, sf).documents, "source")


def _headline_sql() -> str:
    from citytherm.plans.oracle import CONTRAST
    return f"""
WITH {CONTRAST},
  cm AS (SELECT user_id, round_even(contrast * 1000.0, 0) AS milli FROM ct),
  per AS (SELECT user_id, avg(milli) AS gm FROM cm GROUP BY user_id),
  top AS (SELECT user_id AS top_group, gm AS top_group_mean FROM per
          ORDER BY gm DESC, user_id DESC LIMIT 1)
SELECT {R('avg(milli) / 1000.0')} AS mean, max(milli) / 1000.0 AS max, count(*) AS n_rows,
       (SELECT top_group FROM top) AS top_group,
       (SELECT {R('top_group_mean / 1000.0')} FROM top) AS top_group_mean
FROM cm"""


@register("headline", _headline_sql())
def q_headline(spark: SparkSession, sf: str) -> DataFrame:
    """E17 on the 3-decimal contrast, aggregated in thousandths (exact sums)."""
    c = _contrast(Tables(spark, sf)).withColumn("milli", F.rint(F.col("contrast") * 1000.0))
    h = profile.headline(c, "user_id", "milli")
    return round_doubles(h.select((F.col("mean") / 1000.0).alias("mean"), (F.col("max") / 1000.0).alias("max"),
                                  "n_rows", "top_group",
                                  (F.col("top_group_mean") / 1000.0).alias("top_group_mean")))


@register("target_range", f"""
WITH {ORDERS_BY_NATION_SQL},
  agg AS (SELECT n_name, avg(o_totalprice) AS mean FROM obn GROUP BY n_name)
SELECT {R('min(mean)')} AS agg_min, {R('max(mean)')} AS agg_max, {R('avg(mean)')} AS agg_mean,
       (SELECT min(o_totalprice) FROM orders) AS value_min,
       (SELECT max(o_totalprice) FROM orders) AS value_max
FROM agg""")
def q_target_range(spark: SparkSession, sf: str) -> DataFrame:
    """Min / max / mean of a group aggregate, min / max of the raw measure."""
    t = Tables(spark, sf)
    agg = profile.group_mean(_orders_by_nation(spark, t), "n_name", "o_totalprice")
    b = scalars(t.orders.agg(F.min("o_totalprice").alias("value_min"),
                             F.max("o_totalprice").alias("value_max")))
    a = agg.agg(F.min("mean").alias("agg_min"), F.max("mean").alias("agg_max"),
                F.avg("mean").alias("agg_mean"),
                F.first(b("value_min")).alias("value_min"), F.first(b("value_max")).alias("value_max"))
    return round_doubles(a)


# --------------------------------------------------------------------------
# E19 - E21
# --------------------------------------------------------------------------
LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(LINE_NUM):
        for b in LINE_NUM:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0::DOUBLE AS r")
            else:
                parts.append(f"SELECT '{a}', '{b}', {R(f'corr({a}, {b})')} FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.corr_matrix(Tables(spark, sf).lineitem, LINE_NUM))


CORR_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@register("corr_target", f"""
WITH c AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, corr({f}, l_extendedprice) AS r FROM lineitem" for f in CORR_FEATURES)})
SELECT feature, {R('r')} AS r,
       CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS INTEGER) AS abs_rank
FROM c""")
def q_corr_target(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return round_doubles(profile.corr_with_target(li, CORR_FEATURES, "l_extendedprice"))


@register("ols_fit", f"""
SELECT {R('regr_slope(l_extendedprice, l_quantity)')} AS slope,
       {R('regr_intercept(l_extendedprice, l_quantity)')} AS intercept,
       {R('corr(l_extendedprice, l_quantity)')} AS r,
       {R('regr_r2(l_extendedprice, l_quantity)')} AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem""")
def q_ols_fit(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.ols_fit(Tables(spark, sf).lineitem, "l_extendedprice", "l_quantity"))


# --------------------------------------------------------------------------
# E22 - E24, F1, C6
# --------------------------------------------------------------------------
BINS = 40
FINE_BINS = 55


def _histogram_sql(bins: int) -> str:
    return f"""
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
  b AS (SELECT CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / ((hi - lo) / {D(float(bins))})), {bins - 1})
                    ELSE 0 END AS INTEGER) AS bin, count(*) AS n
        FROM events, r WHERE value IS NOT NULL GROUP BY 1),
  e AS (SELECT CAST(range AS INTEGER) AS bin, lo, hi FROM range({bins}), r)
SELECT e.bin, {R(f'lo + e.bin * ((hi - lo) / {D(float(bins))})')} AS lower,
       {R(f'lo + (e.bin + 1) * ((hi - lo) / {D(float(bins))})')} AS upper,
       coalesce(b.n, 0) AS n
FROM e LEFT JOIN b ON e.bin = b.bin"""


@register("histogram_fixed", _histogram_sql(BINS))
def q_histogram_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.histogram(Tables(spark, sf).events, "value", BINS))


@register("histogram_fine", _histogram_sql(FINE_BINS))
def q_histogram_fine(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.histogram(Tables(spark, sf).events, "value", FINE_BINS))


@register("box_summary", f"""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3, avg(value) AS mean, stddev_samp(value) AS sd,
                  count(value) AS n FROM events),
  f AS (SELECT *, q1 - {D(1.5)} * (q3 - q1) AS lower_fence, q3 + {D(1.5)} * (q3 - q1) AS upper_fence FROM q)
SELECT {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3, {R('mean')} AS mean, {R('sd')} AS sd, n,
       {R('lower_fence')} AS lower_fence, {R('upper_fence')} AS upper_fence,
       min(CASE WHEN value BETWEEN lower_fence AND upper_fence THEN value END) AS whisker_low,
       max(CASE WHEN value BETWEEN lower_fence AND upper_fence THEN value END) AS whisker_high,
       count_if(value IS NOT NULL AND NOT (value BETWEEN lower_fence AND upper_fence)) AS n_outliers
FROM events, f GROUP BY ALL""")
def q_box_summary(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.box_summary(Tables(spark, sf).events, "value"))


@register("top_groups_distribution", f"""
WITH m AS (SELECT user_id, avg(value) AS mean FROM events GROUP BY user_id),
  t AS (SELECT * FROM m ORDER BY mean DESC, user_id LIMIT 8)
SELECT e.user_id, {R('t.mean')} AS mean, min(value) AS min, {R('quantile_cont(value, 0.25)')} AS q1,
       {R('quantile_cont(value, 0.5)')} AS median, {R('quantile_cont(value, 0.75)')} AS q3,
       max(value) AS max, count(value) AS n
FROM events e JOIN t ON e.user_id = t.user_id GROUP BY e.user_id, t.mean""")
def q_top_groups_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(profile.top_groups_distribution(Tables(spark, sf).events, "user_id", "value", 8))


# --------------------------------------------------------------------------
# F2 + C5, F5, F6, F11
# --------------------------------------------------------------------------
MEAN_RANGE = (100000.0, 300000.0)


@register("top_bottom", f"""
WITH m AS (SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY o_custkey),
  f AS (SELECT * FROM m WHERE mean BETWEEN {D(MEAN_RANGE[0])} AND {D(MEAN_RANGE[1])}),
  t AS (SELECT o_custkey, mean, 'top' AS side FROM f ORDER BY mean DESC, o_custkey LIMIT 10),
  b AS (SELECT o_custkey, mean, 'bottom' AS side FROM f ORDER BY mean ASC, o_custkey LIMIT 10)
SELECT o_custkey, {R('mean')} AS mean, side FROM t UNION ALL
SELECT o_custkey, {R('mean')} AS mean, side FROM b""")
def q_top_bottom(spark: SparkSession, sf: str) -> DataFrame:
    m = profile.group_mean(Tables(spark, sf).orders, "o_custkey", "o_totalprice")
    m = m.where(F.col("mean").between(*MEAN_RANGE))  # C5
    return round_doubles(profile.top_bottom(m, "o_custkey", "mean", 10))


@register("preview", """
SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY event_id LIMIT 300""")
def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events.select("event_id", "ts", "user_id", "event_type", "value")
    return profile.preview(e, ["event_id"], 300)


@register("seeded_sample", """
SELECT event_id, user_id, value FROM events ORDER BY md5('42' || CAST(event_id AS VARCHAR)), event_id
LIMIT 2000""")
def q_seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events.select("event_id", "user_id", "value")
    return profile.seeded_sample(e, "event_id", 2000, seed=42)


@register("default_keys", """
SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL ORDER BY user_id LIMIT 6""")
def q_default_keys(spark: SparkSession, sf: str) -> DataFrame:
    return profile.default_keys(Tables(spark, sf).events, "user_id", 6)
