"""Landed payloads -> typed rows (A2, A3, A5, A4 input), with explicit schemas.

On a cluster the payload files are read with ``spark.read.schema(S).json``
(no inference); the parsing functions below take the resulting DataFrame,
so they work the same on payloads built in Spark from other tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytherm.functions.expressions import round_half_even
from citytherm.operators.clean import drop_missing

# Daily-array weather payload: {"city": ..., "daily": {"time": [...], ...}}
DAILY_FIELDS = ["temperature_2m_mean", "relative_humidity_2m_mean", "wind_speed_10m_max",
                "surface_pressure_mean", "cloud_cover_mean"]
DAILY_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in DAILY_FIELDS])),
])
# Current-weather payload (nested objects).
CURRENT_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType()),
                                        T.StructField("humidity", T.DoubleType()),
                                        T.StructField("pressure", T.DoubleType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.IntegerType())])),
    T.StructField("dt", T.LongType()),
])
# Surface samples: point tag, date, integer digital number.
SURFACE_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()), T.StructField("pt", T.StringType()),
    T.StructField("date", T.DateType()), T.StructField("dn", T.IntegerType()),
])
# Vegetation samples: scale (m) and raw reading (/ 10000).
VEGETATION_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("scale", T.IntegerType()), T.StructField("raw", T.IntegerType()),
])

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# --------------------------------------------------------------------------
KMH_TO_MS = 1.0 / 3.6
DEFAULT_PRESSURE = 1013.0
DEFAULT_CLOUDS = 50
DN_SCALE, DN_OFFSET = 0.02, -273.15   # surface digital number -> degrees C
VEGETATION_SCALE = 10000.0
VEGETATION_SCALES = [500, 1000, 2000, 5000]  # tried in this order
NOON_STAMP = "T12:00:00"


def read_payloads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON payloads with an explicit schema (one object per line)."""
    return spark.read.schema(schema).json(path)


def daily_rows(payload: DataFrame, zero_is_missing: bool = False) -> DataFrame:
    """A2: one row per day from index-aligned arrays.

    A day with a null temperature, humidity or wind is dropped (C3); wind
    km/h -> m/s (2 places); pressure and clouds fall back to defaults when
    null (and, with ``zero_is_missing``, when 0, as the reference's
    truthiness test does); the date is stamped at noon.  ``arrays_zip`` +
    ``inline`` keeps every row's arrays inside its own task.
    """
    # an absent array (field missing from the payload) zips as nulls, not as
    # a null row set: arrays_zip pads the shorter arrays
    def arr(f, t):
        return F.coalesce(F.col(f"daily.{f}"), F.array().cast(f"array<{t}>")).alias(f)
    d = payload.select("city", F.inline(F.arrays_zip(
        arr("time", "string"), *[arr(f, "double") for f in DAILY_FIELDS])))
    d = drop_missing(d, ["temperature_2m_mean", "relative_humidity_2m_mean", "wind_speed_10m_max"])
    p, c = F.col("surface_pressure_mean"), F.col("cloud_cover_mean")
    p_ok = p.isNotNull() & (p != 0) if zero_is_missing else p.isNotNull()
    c_ok = c.isNotNull() & (c != 0) if zero_is_missing else c.isNotNull()
    return d.select(
        F.col("city").alias("name"), "time",
        round_half_even("temperature_2m_mean", 2).alias("temperature"),
        round_half_even("relative_humidity_2m_mean", 1).alias("humidity"),
        round_half_even(F.col("wind_speed_10m_max") / F.lit(3.6), 2).alias("wind_speed"),
        F.when(p_ok, round_half_even(p, 1)).otherwise(F.lit(DEFAULT_PRESSURE)).alias("pressure"),
        F.when(c_ok, F.rint(c).cast("int")).otherwise(F.lit(DEFAULT_CLOUDS)).alias("clouds"),
        F.concat(F.substring(F.col("time"), 1, 10), F.lit(NOON_STAMP)).alias("timestamp"))


def current_row(payload: DataFrame, zero_is_missing: bool = False, keep=()) -> DataFrame:
    """A3: one row per current-weather object; defaults 1013 / 50; epoch -> UTC text.

    ``keep`` carries extra columns of the payload frame through."""
    p, c = F.col("main.pressure"), F.col("clouds.all")
    p_ok = p.isNotNull() & (p != 0) if zero_is_missing else p.isNotNull()
    c_ok = c.isNotNull() & (c != 0) if zero_is_missing else c.isNotNull()
    # epoch seconds -> UTC wall clock, independent of the session time zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ts = F.date_format(epoch + F.make_dt_interval(secs=F.col("dt").cast("decimal(18,6)")),
                       "yyyy-MM-dd'T'HH:mm:ss")
    return payload.select(
        *keep, F.col("city").alias("name"),
        F.col("main.temp").alias("temperature"), F.col("main.humidity").alias("humidity"),
        F.col("wind.speed").alias("wind_speed"),
        F.when(p_ok, p).otherwise(F.lit(DEFAULT_PRESSURE)).alias("pressure"),
        F.when(c_ok, c).otherwise(F.lit(DEFAULT_CLOUDS)).alias("clouds"),
        ts.alias("timestamp"))


def surface_readings(samples: DataFrame, dn_col: str = "dn", date_col: str = "date") -> DataFrame:
    """A5: drop null date / reading, digital number -> degrees (B2)."""
    s = samples.where(F.col(date_col).isNotNull() & F.col(dn_col).isNotNull())
    return s.withColumn("lst", F.col(dn_col) * F.lit(DN_SCALE) + F.lit(DN_OFFSET))


def vegetation_index(samples: DataFrame, start: str, end: str, key: str = "city",
                     scales=VEGETATION_SCALES) -> DataFrame:
    """A4: mean raw reading per scale inside [start, end), the first scale
    (in ``scales`` order) with a value, / 10000 to 4 places; keys without
    any value are absent."""
    from citytherm.operators.align import first_by_priority
    s = samples.where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
    return first_by_priority(s, key, "scale", "raw", list(scales), scale=VEGETATION_SCALE,
                             digits=4, out_value="ndvi", out_source="scale")
