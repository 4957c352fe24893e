"""Registered queries: ingest and alignment around the sources
(A1-A5, A6-A11, B1-B3, C3, C4, D3, G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.functions.stats import scalars
from citytherm.operators import align
from citytherm.plans.cleaning import D, R
from citytherm.plans.common import cities_values_sql, nation_cities, round_doubles
from citytherm.plans.registry import register
from citytherm.session import shared_dir
from citytherm.sources import payloads, stages
from citytherm.sources.cities import RURAL_OFFSETS, probe_points
from citytherm.sources.tables import Tables


# --------------------------------------------------------------------------
# A2: daily arrays built from events per (user, day), parsed back to rows
# --------------------------------------------------------------------------
def _daily_payloads(t: Tables) -> DataFrame:
    """Payloads of index-aligned arrays in event-time order, one per user,
    day and block of event ids (at most 1024 elements each)."""
    e = t.events
    v = F.col("value")
    item = F.struct(
        F.col("ts").alias("_ts"), F.col("event_id").alias("_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("time"),
        v.alias("temperature_2m_mean"),
        F.when(F.col("event_type") != "error", v % 100).alias("relative_humidity_2m_mean"),
        v.alias("wind_speed_10m_max"),
        F.when(F.col("event_type") != "view", F.lit(1000.0) + v % 50).alias("surface_pressure_mean"),
        F.when(F.col("event_type") == "click", F.lit(0.0)).otherwise(v % 100).alias("cloud_cover_mean"))
    # one payload per (user, day, block of 1024 event ids): arrays stay
    # bounded even when one user holds a third of all events
    g = (e.groupBy(F.col("user_id").cast("string").alias("city"), F.to_date("ts").alias("_d"),
                   F.floor(F.col("event_id") / 1024).alias("_b"))
          .agg(F.array_sort(F.collect_list(item)).alias("_a")))
    def field(name):
        return F.transform("_a", lambda x: x[name]).alias(name)
    daily = F.struct(field("time"), *[field(f) for f in payloads.DAILY_FIELDS])
    return g.select("city", daily.alias("daily"))


@register("parallel_arrays", f"""
WITH x AS (
  SELECT CAST(user_id AS VARCHAR) AS name, strftime(ts, '%Y-%m-%d') AS time, value AS t,
         CASE WHEN event_type <> 'error' THEN value % 100 END AS h, value AS w,
         CASE WHEN event_type <> 'view' THEN 1000.0::DOUBLE + value % 50 END AS p,
         CASE WHEN event_type = 'click' THEN 0.0::DOUBLE ELSE value % 100 END AS c
  FROM events)
SELECT name, time, {R('t', 2)} AS temperature, {R('h', 1)} AS humidity, {R('w / 3.6::DOUBLE', 2)} AS wind_speed,
       CASE WHEN p IS NOT NULL AND p <> 0 THEN {R('p', 1)} ELSE 1013.0::DOUBLE END AS pressure,
       CASE WHEN c IS NOT NULL AND c <> 0 THEN CAST(round_even(c, 0) AS INTEGER) ELSE 50 END AS clouds,
       time || 'T12:00:00' AS timestamp
FROM x WHERE t IS NOT NULL AND h IS NOT NULL AND w IS NOT NULL""")
def q_parallel_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rows = payloads.daily_rows(_daily_payloads(Tables(spark, sf)), zero_is_missing=True)
    return rows


# --------------------------------------------------------------------------
# A3: nested payload text -> typed fields with defaults
# --------------------------------------------------------------------------
PAYLOAD_SCHEMA = ("city STRING, main STRUCT<temp: DOUBLE, humidity: DOUBLE, pressure: DOUBLE>, wind STRUCT<speed: DOUBLE>, "
                  "clouds STRUCT<`all`: INT>, dt BIGINT")


def _current_payloads(t: Tables) -> DataFrame:
    """One current-weather object as JSON text per event; views come without pressure,
    clicks without clouds, errors without the whole main object."""
    v, kind = F.col("value"), F.col("event_type")
    main = F.struct(v.alias("temp"), F.when(v > 10, v % 100).alias("humidity"), F.when(kind != "view", F.lit(1000.0) + v % 50).alias("pressure"))
    clouds = F.struct((F.col("event_id") % 101).cast("int").alias("all"))
    text = F.to_json(F.struct(F.col("user_id").cast("string").alias("city"), F.when(kind != "error", main).alias("main"),
                              F.struct((v / 4).alias("speed")).alias("wind"), F.when(kind != "click", clouds).alias("clouds"),
                              F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("dt")))
    return t.events.select("event_id", text.alias("payload"))


@register("nested_payload", f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS name, CASE WHEN event_type <> 'error' THEN value END AS temperature,
       CASE WHEN event_type <> 'error' AND value > 10 THEN value % 100 END AS humidity, value / 4 AS wind_speed,
       CASE WHEN event_type NOT IN ('view', 'error') AND value IS NOT NULL THEN 1000.0::DOUBLE + value % 50 ELSE {D(payloads.DEFAULT_PRESSURE)} END AS pressure,
       CASE WHEN event_type <> 'click' THEN CAST(event_id % 101 AS INTEGER) ELSE {int(payloads.DEFAULT_CLOUDS)} END AS clouds,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp
FROM events""")
def q_nested_payload(spark: SparkSession, sf: str) -> DataFrame:
    e = _current_payloads(Tables(spark, sf)).select("event_id", F.from_json("payload", PAYLOAD_SCHEMA).alias("p"))
    return payloads.current_row(e.select("event_id", "p.*"), keep=["event_id"])


# --------------------------------------------------------------------------
# A5: integer readings per (user, type, day) -> degrees
# --------------------------------------------------------------------------
@register("tagged_samples", f"""
SELECT event_id, user_id, event_type AS pt, CAST(ts AS DATE) AS date,
       CAST(floor(value * 100) AS INTEGER) AS dn,
       {R('CAST(floor(value * 100) AS INTEGER) * 0.02::DOUBLE + (-273.15::DOUBLE)')} AS lst
FROM events WHERE ts IS NOT NULL AND value IS NOT NULL""")
def q_tagged_samples(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events
    s = e.select("event_id", "user_id", F.col("event_type").alias("pt"), F.to_date("ts").alias("date"),
                 F.floor(F.col("value") * 100).cast("int").alias("dn"))
    return round_doubles(payloads.surface_readings(s))


# --------------------------------------------------------------------------
# A4: first non-null mean in priority order
# --------------------------------------------------------------------------
PRIORITY = ["purchase", "click", "view", "signup"]
WINDOW = ("2024-01-01", "2024-01-04")


@register("priority_source", f"""
WITH m AS (SELECT user_id, event_type, avg(value) AS mv FROM events
           WHERE ts >= TIMESTAMP '{WINDOW[0]}' AND ts < TIMESTAMP '{WINDOW[1]}'
             AND event_type IN ({', '.join(f"'{p}'" for p in PRIORITY)})
           GROUP BY user_id, event_type),
  p AS (SELECT *, CASE event_type {' '.join(f"WHEN '{p}' THEN {i + 1}" for i, p in enumerate(PRIORITY))} END AS pos
        FROM m WHERE mv IS NOT NULL)
SELECT user_id, arg_min(event_type, pos) AS source, {R('arg_min(mv, pos) / 100.0::DOUBLE', 4)} AS value
FROM p GROUP BY user_id""")
def q_priority_source(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).events
    e = e.where((F.col("ts") >= F.lit(WINDOW[0]).cast("timestamp_ntz"))
                & (F.col("ts") < F.lit(WINDOW[1]).cast("timestamp_ntz")))
    return align.first_by_priority(e, "user_id", "event_type", "value", PRIORITY, scale=100.0, digits=4)


# --------------------------------------------------------------------------
# D3 + G1: primary rows, else the latest row, else nothing
# --------------------------------------------------------------------------
CUTOFF = "1996-01-01"


@register("fallback_union", f"""
WITH prim AS (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice, o_orderdate, 'primary' AS source
              FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}'),
  lat AS (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice, o_orderdate,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
SELECT * FROM prim
UNION ALL
SELECT c_custkey, o_orderkey, o_totalprice, o_orderdate, 'fallback' FROM lat
WHERE rn = 1 AND c_custkey NOT IN (SELECT c_custkey FROM prim)""")
def q_fallback_union(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate")
    primary = o.where(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))
    known = o.join(t.customer.select("c_custkey"), "c_custkey", "left_semi")
    fallback = align.latest_per_key(known, "c_custkey", ["o_orderdate", "o_orderkey"])
    return align.fallback_union(primary, fallback, "c_custkey")


# --------------------------------------------------------------------------
# B1 + A1: probe points around each supplier's city
# --------------------------------------------------------------------------
def _probe_sql() -> str:
    offs = ", ".join(f"('rural_{i}', {D(a)}, {D(b)})" for i, (a, b) in enumerate(RURAL_OFFSETS))
    return f"""
WITH nc AS (SELECT n.n_nationkey, cv.city, cv.lat, cv.lon FROM nation n
            JOIN {cities_values_sql()} ON n.n_nationkey + 1 = cv.city_pos),
  s AS (SELECT s.s_suppkey, nc.city, nc.lat, nc.lon FROM supplier s JOIN nc ON s.s_nationkey = nc.n_nationkey),
  o AS (SELECT * FROM (VALUES ('urban', 0.0::DOUBLE, 0.0::DOUBLE), {offs}) v(pt, dlat, dlon))
SELECT s_suppkey, city, lat, lon, pt, {R('lat + dlat')} AS probe_lat, {R('lon + dlon')} AS probe_lon
FROM s, o"""


@register("probe_points", _probe_sql())
def q_probe_points(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    nc = nation_cities(spark, t)
    sites = (t.supplier.select("s_suppkey", "s_nationkey")
             .join(F.broadcast(nc), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 rows
             .select("s_suppkey", "city", "lat", "lon"))
    return round_doubles(probe_points(sites))


# --------------------------------------------------------------------------
# C4: trailing window ending a lag before the as-of date
# --------------------------------------------------------------------------
LAG_DAYS, SPAN_DAYS = 30, 180


@register("trailing_window", f"""
WITH b AS (SELECT CAST(max(o_orderdate) AS DATE) - {LAG_DAYS} AS e FROM orders)
SELECT o_orderkey, o_orderdate FROM orders, b
WHERE CAST(o_orderdate AS DATE) BETWEEN b.e - {SPAN_DAYS - 1} AND b.e""")
def q_trailing_window(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    end = scalars(o.agg(F.date_sub(F.to_date(F.max("o_orderdate")), LAG_DAYS).alias("_e")))("_e")
    d = F.to_date("o_orderdate")
    return o.where(d.between(F.date_sub(end, SPAN_DAYS - 1), end)).select("o_orderkey", "o_orderdate")


# --------------------------------------------------------------------------
# Stage tables through CSV, JSON and Parquet
# --------------------------------------------------------------------------
@register("stage_tables", """
SELECT v.format, count(*) AS n_rows, CAST((SELECT count(*) FROM pragma_table_info('events')) AS INTEGER) AS n_columns,
       CAST(round_even(sum(e.value) * 1e3, 0) / 1e3 AS DOUBLE) AS sum_value
FROM events e, (VALUES ('csv'), ('json'), ('parquet')) v(format) GROUP BY v.format""")
def q_stage_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Write events as CSV (with header), JSON and Parquet under the shared
    folder, read each back with the explicit schema, write again without
    ``force`` (kept, A10); report rows and columns per format."""
    e = Tables(spark, sf).events
    schema = e.schema
    root = shared_dir(spark, "stage-tables")
    out = []
    for fmt in ("csv", "json", "parquet"):
        path = f"{root}/{fmt}"
        stages.write_stage(e, path, fmt=fmt, force=True)
        stages.write_stage(e.limit(0), path, fmt=fmt, force=False)  # ignored: table exists
        back = stages.read_stage(spark, path, schema=schema, fmt=fmt)
        out.append(back.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n_rows"),
                            F.lit(len(back.columns)).alias("n_columns"),
                            F.sum("value").alias("sum_value")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return round_doubles(res, 3)
