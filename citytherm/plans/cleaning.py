"""Registered queries: cleaning and feature operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.functions import expressions as X
from citytherm.operators import clean, features, preprocess
from citytherm.plans.common import (CHECK_DIGITS, lineitem_observations,
                                    lineitem_observations_sql, round_doubles)
from citytherm.plans.registry import register
from citytherm.sources.tables import Tables

TWO_PI = repr(2.0 * math.pi)


def R(expr: str, d: int = CHECK_DIGITS) -> str:
    return f"(round_even(({expr}) * 1e{d}, 0) / 1e{d})"


def D(x) -> str:
    """A double literal in DuckDB (plain decimals there are DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


# --------------------------------------------------------------------------
# C1
# --------------------------------------------------------------------------
SOURCE_PATTERN = "src1|src7"


@register("source_filter", f"""
SELECT doc_id, source, lang, n_chars FROM documents
WHERE coalesce(regexp_matches(source, '{SOURCE_PATTERN}'), false)""")
def q_source_filter(spark: SparkSession, sf: str) -> DataFrame:
    d = Tables(spark, sf).documents.select("doc_id", "source", "lang", "n_chars")
    return clean.source_filter(d, "source", SOURCE_PATTERN)


# --------------------------------------------------------------------------
# C2
# --------------------------------------------------------------------------
LINE_RANGES = {"l_quantity": (5, 45), "l_discount": (0.01, 0.09), "l_tax": (0.0, 0.06)}


@register("range_validity", f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_quantity BETWEEN 5 AND 45
  AND l_discount BETWEEN {D(0.01)} AND {D(0.09)}
  AND l_tax BETWEEN {D(0.0)} AND {D(0.06)}""")
def q_range_validity(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                                           "l_discount", "l_tax")
    return clean.range_filter(li, LINE_RANGES)


# --------------------------------------------------------------------------
# B5 + B3
# --------------------------------------------------------------------------
SUPPLIER_DEFAULTS = {"s_acctbal": 0.0, "s_rating": 50, "s_phone": "unknown", "s_lst": None}


@register("inject_defaults", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(50 AS INTEGER) AS s_rating,
       'unknown' AS s_phone, CAST(NULL AS DOUBLE) AS s_lst,
       coalesce(nullif(s_nationkey, 0), 99) AS nation_or_default
FROM supplier""")
def q_inject_defaults(spark: SparkSession, sf: str) -> DataFrame:
    s = Tables(spark, sf).supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    s = clean.inject_defaults(s, SUPPLIER_DEFAULTS)
    return s.withColumn("nation_or_default",
                        X.default_if_missing("s_nationkey", 99, zero_is_missing=True))


# --------------------------------------------------------------------------
# E4
# --------------------------------------------------------------------------
@register("median_impute", """
WITH e AS (SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value
           FROM events),
     m AS (SELECT median(value) AS mv FROM e)
SELECT event_id, event_type, coalesce(value, mv) AS value FROM e, m""")
def q_median_impute(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events.select(
        "event_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return clean.median_impute(e, ["value"])


# --------------------------------------------------------------------------
# E2 / E29 / E3
# --------------------------------------------------------------------------
def _fences_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, {R('q1', 3)} AS q1, {R('q3', 3)} AS q3, {R('q3 - q1', 3)} AS iqr,
       {R('lo', 3)} AS lower_fence, {R('hi', 3)} AS upper_fence,
       nl AS n_low, nh AS n_high, nl + nh AS n_capped,
       {R(f'{D(100.0)} * (nl + nh) / greatest(n, 1)', 2)} AS pct
FROM (SELECT q1, q3, q1 - {D(1.5)} * (q3 - q1) AS lo, q3 + {D(1.5)} * (q3 - q1) AS hi
      FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table})) f,
     LATERAL (SELECT count(*) AS n, count_if({c} < f.lo) AS nl, count_if({c} > f.hi) AS nh
              FROM {table}) k""")
    return "\nUNION ALL\n".join(parts)


LINE_FENCE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("iqr_fences", _fences_sql("lineitem", LINE_FENCE_COLS))
def q_iqr_fences(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return clean.outlier_report(li, LINE_FENCE_COLS)


@register("iqr_fences_events", _fences_sql("events", ["value"]))
def q_iqr_fences_events(spark: SparkSession, sf: str) -> DataFrame:
    return clean.outlier_report(Tables(spark, sf).events, ["value"])


@register("winsorize", f"""
WITH f AS (SELECT q1 - {D(1.5)} * (q3 - q1) AS lo, q3 + {D(1.5)} * (q3 - q1) AS hi
           FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
                 FROM events))
SELECT event_id, CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END AS value
FROM events, f""")
def q_winsorize(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events.select("event_id", "value")
    return clean.winsorize(e, ["value"])


# --------------------------------------------------------------------------
# B6 / B7 / B10 / B14
# --------------------------------------------------------------------------
MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in X.MONTH_NAMES) + "]"


@register("calendar_features", f"""
WITH c AS (SELECT event_id, CAST(coalesce(hour(ts), 12) AS INTEGER) AS hour,
                  CAST(coalesce(month(ts), 6) AS INTEGER) AS month FROM events)
SELECT event_id, hour, month,
       CAST(hour BETWEEN 6 AND 18 AS INTEGER) AS is_daytime,
       CAST(hour < 6 OR hour > 18 AS INTEGER) AS is_night,
       {R(f'sin({TWO_PI} * hour / 24.0)')} AS hour_sin, {R(f'cos({TWO_PI} * hour / 24.0)')} AS hour_cos,
       {R(f'sin({TWO_PI} * month / 12.0)')} AS month_sin, {R(f'cos({TWO_PI} * month / 12.0)')} AS month_cos,
       {MONTHS_SQL}[month] AS month_name
FROM c""")
def q_calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events.select("event_id", "ts")
    hs, hc = X.cyclical("hour", 24)
    ms, mc = X.cyclical("month", 12)
    out = (e.withColumns({"hour": X.hour_or_default("ts"), "month": X.month_or_default("ts")})
            .select("event_id", "hour", "month",
                    X.is_daytime("hour").alias("is_daytime"), X.is_night("hour").alias("is_night"),
                    hs.alias("hour_sin"), hc.alias("hour_cos"), ms.alias("month_sin"),
                    mc.alias("month_cos"), X.month_name("month").alias("month_name")))
    return round_doubles(out)


# --------------------------------------------------------------------------
# B8
# --------------------------------------------------------------------------
DISCOUNT_CUTS = (0.02, 0.05)


def _bin_sql(x: str, cuts, op: str) -> str:
    cl = f"least(greatest({x}, {D(-1.0)}), {D(1.0)})"
    whens = " ".join(f"WHEN {cl} {op} {D(c)} THEN {i}" for i, c in enumerate(cuts))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE {len(cuts)} END"


@register("bin_right_closed", f"""
SELECT l_orderkey, l_linenumber, l_discount,
       {_bin_sql('l_discount', DISCOUNT_CUTS, '<=')} AS bin,
       {_bin_sql('l_discount', DISCOUNT_CUTS, '<')} AS bin_left
FROM lineitem""")
def q_bin_right_closed(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_discount")
    return li.select("*", X.right_closed_bin("l_discount", DISCOUNT_CUTS).alias("bin"),
                     X.left_closed_bin("l_discount", DISCOUNT_CUTS).alias("bin_left"))


# --------------------------------------------------------------------------
# B9 / B11 / B12
# --------------------------------------------------------------------------
def _heat_index_sql(t: str, h: str, coeffs) -> str:
    c0, c1, c2, c3 = (D(c) for c in coeffs)
    return f"{c0} + {c1} * {t} + {c2} * ({h} / 100.0) + {c3} * {t} * ({h} / 100.0)"


@register("interactions", f"""
WITH o AS ({lineitem_observations_sql()})
SELECT l_orderkey, l_linenumber,
  {R('temperature * humidity / 100.0')} AS temp_humidity_interaction,
  {R('wind_speed * CASE WHEN temperature - 20.0 IS NOT NULL THEN greatest(temperature - 20.0, 0.0) END')} AS wind_cooling_effect,
  {R('urban_fraction * temperature / (wind_speed + 1.0)')} AS heat_retention,
  {R(_heat_index_sql('temperature', 'humidity', X.HEAT_INDEX_TRAIN))} AS heat_index,
  {R(_heat_index_sql('temperature', 'humidity', X.HEAT_INDEX_SCORE))} AS heat_index_score,
  {R('abs(lat)')} AS lat_abs, {R('sin(radians(lon))')} AS lon_sin, {R('cos(radians(lon))')} AS lon_cos,
  {R('abs(lat)')} AS distance_from_equator
FROM o""")
def q_interactions(spark: SparkSession, sf: str) -> DataFrame:
    o = lineitem_observations(spark, Tables(spark, sf))
    geo = X.geo_encoding("lat", "lon")
    out = o.select(
        "l_orderkey", "l_linenumber",
        X.temp_humidity_interaction("temperature", "humidity").alias("temp_humidity_interaction"),
        X.wind_cooling_effect("wind_speed", "temperature").alias("wind_cooling_effect"),
        X.heat_retention("urban_fraction", "temperature", "wind_speed").alias("heat_retention"),
        X.heat_index("temperature", "humidity").alias("heat_index"),
        X.heat_index("temperature", "humidity", X.HEAT_INDEX_SCORE).alias("heat_index_score"),
        *[v.alias(k) for k, v in geo.items()])
    return round_doubles(out)


# --------------------------------------------------------------------------
# E6
# --------------------------------------------------------------------------
@register("group_anomaly", f"""
WITH g AS (SELECT o_custkey, avg(o_totalprice) AS m FROM orders WHERE o_custkey IS NOT NULL
           GROUP BY o_custkey)
SELECT o.o_orderkey, o.o_custkey, {R('o.o_totalprice - g.m', 3)} AS anomaly
FROM orders o LEFT JOIN g ON o.o_custkey = g.o_custkey""")
def q_group_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return (features.group_anomaly(o, "o_custkey", "o_totalprice", "anomaly")
            .select("o_orderkey", "o_custkey", "anomaly"))


# --------------------------------------------------------------------------
# B15
# --------------------------------------------------------------------------
def _band_sql(x: str, cuts, labels) -> str:
    whens = " ".join(f"WHEN {x} < {D(c)} THEN '{lab}'" for c, lab in zip(cuts, labels))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


@register("severity_bands", f"""
SELECT event_id, value,
  {_band_sql('value / 10.0', X.SEVERITY_SCORE_CUTS, X.SEVERITY_SCORE_LABELS)} AS severity,
  {_band_sql('value / 10.0', X.SEVERITY_TABLE_CUTS, X.SEVERITY_TABLE_LABELS)} AS band
FROM events""")
def q_severity_bands(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events.select("event_id", "value")
    scaled = F.col("value") / F.lit(10.0)
    return e.select("event_id", "value", X.severity_score(scaled).alias("severity"),
                    X.severity_table(scaled).alias("band"))


# --------------------------------------------------------------------------
# Full chain: C1 -> B5 -> E4 -> C2 -> E2/E3 -> B6..B12, E6 -> E5 -> B13
# --------------------------------------------------------------------------
CAP = ["temperature", "humidity", "wind_speed", "pressure", "clouds", "ndvi"]


def _feature_row_sql() -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in CAP)
    fences = ", ".join(f"{c}_q1 - {D(1.5)} * ({c}_q3 - {c}_q1) AS {c}_lo, "
                       f"{c}_q3 + {D(1.5)} * ({c}_q3 - {c}_q1) AS {c}_hi" for c in CAP)
    capped = ", ".join(
        f"CASE WHEN CAST({c} AS DOUBLE) < {c}_lo THEN {c}_lo WHEN CAST({c} AS DOUBLE) > {c}_hi "
        f"THEN {c}_hi ELSE CAST({c} AS DOUBLE) END AS {c}" for c in CAP)
    hi = _heat_index_sql("temperature", "humidity", X.HEAT_INDEX_TRAIN)
    ints = set(features.INT_FEATURES) - {"clouds"}  # clouds is double once capped
    names = features.FEATURE_COLUMNS + features.EXTENDED_COLUMNS
    final = ", ".join(n if n in ints else f"{R(n)} AS {n}" for n in names)
    return f"""
WITH o AS ({lineitem_observations_sql()}),
f1 AS (SELECT * FROM o WHERE coalesce(regexp_matches(source, 'openweather|openmeteo'), false)),
f2 AS (SELECT * FROM f1 WHERE temperature BETWEEN -60 AND 60 AND humidity BETWEEN 0 AND 100
        AND wind_speed BETWEEN 0 AND 100 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180),
fq AS (SELECT {q} FROM f2),
fe AS (SELECT {fences} FROM fq),
f3 AS (SELECT l_orderkey, l_linenumber, name, lat, lon, timestamp, urban_fraction, urban_lst,
              rural_lst, {capped} FROM f2, fe),
f4 AS (SELECT *, CAST(coalesce(hour(timestamp), 12) AS INTEGER) AS hour,
              CAST(coalesce(month(timestamp), 6) AS INTEGER) AS month FROM f3),
gm AS (SELECT name, avg(temperature) AS tmean FROM f4 WHERE name IS NOT NULL GROUP BY name),
f5 AS (SELECT f4.*,
  CAST(hour BETWEEN 6 AND 18 AS INTEGER) AS is_daytime,
  CAST(hour < 6 OR hour > 18 AS INTEGER) AS is_night,
  {_bin_sql('ndvi', (0.2, 0.5), '<=')} AS veg_class,
  temperature * humidity / 100.0 AS temp_humidity_interaction,
  wind_speed * CASE WHEN temperature - 20.0 IS NOT NULL THEN greatest(temperature - 20.0, 0.0) END
    AS wind_cooling_effect,
  {R('urban_fraction * temperature / (wind_speed + 1.0)', 3)} AS heat_retention,
  {R('temperature - gm.tmean', 3)} AS temp_anomaly,
  sin({TWO_PI} * hour / 24.0) AS hour_sin, cos({TWO_PI} * hour / 24.0) AS hour_cos,
  sin({TWO_PI} * month / 12.0) AS month_sin, cos({TWO_PI} * month / 12.0) AS month_cos,
  abs(lat) AS lat_abs, sin(radians(lon)) AS lon_sin, cos(radians(lon)) AS lon_cos,
  abs(lat) AS distance_from_equator,
  {R(hi, 3)} AS heat_index,
  CASE WHEN urban_lst IS NOT NULL AND rural_lst IS NOT NULL
       THEN greatest(urban_lst - rural_lst, 0.0) END AS pair
  FROM f4 LEFT JOIN gm ON f4.name = gm.name),
tg AS (SELECT name, median(pair) AS gmed FROM f5 WHERE name IS NOT NULL GROUP BY name),
ta AS (SELECT median(pair) AS glob FROM f5)
SELECT {final},
  {R(R("CASE WHEN coalesce(pair, tg.gmed, ta.glob) IS NOT NULL THEN greatest(coalesce(pair, tg.gmed, ta.glob), 0.0) END", 3))} AS uhi_intensity,
  f5.name AS city_name, l_orderkey, l_linenumber
FROM f5 LEFT JOIN tg ON f5.name = tg.name CROSS JOIN ta"""


@register("feature_row", _feature_row_sql())
def q_feature_row(spark: SparkSession, sf: str) -> DataFrame:
    raw = lineitem_observations(spark, Tables(spark, sf))
    prep = preprocess.preprocess(raw, keep=["l_orderkey", "l_linenumber"])
    return round_doubles(prep.table)


def _outlier_report_sql() -> str:
    return f"""
WITH o AS ({lineitem_observations_sql()}),
f1 AS (SELECT * FROM o WHERE coalesce(regexp_matches(source, 'openweather|openmeteo'), false)),
f2 AS (SELECT * FROM f1 WHERE temperature BETWEEN -60 AND 60 AND humidity BETWEEN 0 AND 100
        AND wind_speed BETWEEN 0 AND 100 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)
{_fences_sql("f2", CAP)}"""


@register("outlier_report", _outlier_report_sql())
def q_outlier_report(spark: SparkSession, sf: str) -> DataFrame:
    """E2 report of the full chain: fences and counts of the capped columns
    on the validated rows."""
    raw = lineitem_observations(spark, Tables(spark, sf))
    return preprocess.preprocess(raw, keep=["l_orderkey", "l_linenumber"]).outliers
