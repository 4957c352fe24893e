"""Shared pieces of the registered queries: the mapping of the shared test
tables onto the observation roles, and the 25-city dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.functions.expressions import round_half_even
from citytherm.sources.cities import city_frame
from citytherm.sources.tables import Tables

# Query parameters (fixed per query so Spark and the SQL oracle agree).
REFERENCE_TYPE = "purchase"   # the "urban" tag among event types
MATCH_TOLERANCE_DAYS = 1      # events span 30 days; 1 day leaves some rows unmatched
CHECK_DIGITS = 6              # rounding depth of float outputs in checked queries


def rnd(c, digits: int = CHECK_DIGITS):
    return round_half_even(c, digits)


def events_samples(t: Tables) -> DataFrame:
    """events as tagged samples: key user_id, day, tag event_type, value."""
    e = t.events
    return e.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"),
                    "event_type", "value",
                    F.struct("ts", "event_id").alias("ord"))


def nation_cities(spark: SparkSession, t: Tables) -> DataFrame:
    """nation keyed to the city list by position (nation key k <-> city k+1)."""
    cities = city_frame(spark)
    return (t.nation.select("n_nationkey", "n_name", "n_regionkey")
            .join(F.broadcast(cities), F.col("n_nationkey") + 1 == F.col("city_pos"))
            .select("n_nationkey", "n_name", "n_regionkey", "city", "lat", "lon"))


def round_doubles(df: DataFrame, digits: int = CHECK_DIGITS) -> DataFrame:
    """Round every DOUBLE column (checked queries only)."""
    return df.select(*[rnd(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def lineitem_observations(spark: SparkSession, t: Tables) -> DataFrame:
    """lineitem as city observations (one row per line item).

    The supplier's nation is the group ("city"), located at the city of the
    same position; quantity, discount and tax drive temperature, humidity and
    wind; unit price gives the urban reading and quantity x discount the
    urban-rural contrast, so models have something to learn.  Line 7 carries
    no urban reading (exercises the target fallbacks); return flag R rows
    come from a source that the source filter rejects; a discount of 0.10
    gives humidity above 100 (rejected by the range check).
    """
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                           "l_shipdate")
    sup = t.supplier.select("s_suppkey", "s_nationkey")
    nc = nation_cities(spark, t)
    j = (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(F.broadcast(nc), F.col("s_nationkey") == F.col("n_nationkey")))  # 25 rows
    unit = F.col("l_extendedprice") / F.col("l_quantity") / F.lit(50.0)
    ndvi = round_half_even(F.lit(0.1) + F.lit(0.15) * F.col("n_regionkey"), 4)
    urban = round_half_even(unit, 3)
    rural = round_half_even(unit - F.col("l_quantity") * F.col("l_discount") / F.lit(5.0), 3)
    return j.select(
        "l_orderkey", "l_linenumber",
        F.col("n_name").alias("name"), "lat", "lon",
        ((F.col("l_quantity") - 10.0) * 1.5).alias("temperature"),
        (F.col("l_discount") * 1100.0).alias("humidity"),
        (F.col("l_tax") * 100.0).alias("wind_speed"),
        (F.lit(990.0) + F.col("l_linenumber") * 5.0).alias("pressure"),
        (F.col("l_linenumber") * 12).cast("int").alias("clouds"),
        F.col("l_shipdate").alias("timestamp"),
        ndvi.alias("ndvi"),
        round_half_even(F.greatest(F.least(F.lit(1.0) - ndvi, F.lit(1.0)), F.lit(0.0)), 3)
        .alias("urban_fraction"),
        F.when(F.col("l_linenumber") != 7, urban).alias("urban_lst"),
        rural.alias("rural_lst"),
        F.when(F.col("l_returnflag") == "R", F.lit("manual"))
         .when(F.col("l_returnflag") == "A", F.lit("openweather"))
         .otherwise(F.lit("openmeteo+gee")).alias("source"))


def _sql_r(expr: str, d: int) -> str:
    return f"(round_even(({expr}) * 1e{d}, 0) / 1e{d})"


def cities_values_sql() -> str:
    from citytherm.sources.cities import CITIES
    rows = ", ".join(f"({i + 1}, '{n}', CAST({la!r} AS DOUBLE), CAST({lo!r} AS DOUBLE))"
                     for i, (n, la, lo) in enumerate(CITIES))
    return f"(VALUES {rows}) AS cv(city_pos, city, lat, lon)"


def nation_cities_sql() -> str:
    return (f"SELECT n.n_nationkey, n.n_name, n.n_regionkey, cv.city, cv.lat, cv.lon "
            f"FROM nation n JOIN {cities_values_sql()} ON n.n_nationkey + 1 = cv.city_pos")


def lineitem_observations_sql() -> str:
    unit = "l.l_extendedprice / l.l_quantity / 50.0"
    ndvi = _sql_r("0.1::DOUBLE + 0.15::DOUBLE * CAST(nc.n_regionkey AS DOUBLE)", 4)
    return f"""
    SELECT l.l_orderkey, l.l_linenumber, nc.n_name AS name, nc.lat, nc.lon,
           (l.l_quantity - 10.0) * 1.5 AS temperature,
           l.l_discount * 1100.0 AS humidity,
           l.l_tax * 100.0 AS wind_speed,
           990.0 + l.l_linenumber * 5.0 AS pressure,
           CAST(l.l_linenumber * 12 AS INTEGER) AS clouds,
           l.l_shipdate AS timestamp,
           {ndvi} AS ndvi,
           {_sql_r(f"greatest(least(1.0 - {ndvi}, 1.0), 0.0)", 3)} AS urban_fraction,
           CASE WHEN l.l_linenumber <> 7 THEN {_sql_r(unit, 3)} END AS urban_lst,
           {_sql_r(f"{unit} - l.l_quantity * l.l_discount / 5.0", 3)} AS rural_lst,
           CASE WHEN l.l_returnflag = 'R' THEN 'manual'
                WHEN l.l_returnflag = 'A' THEN 'openweather'
                ELSE 'openmeteo+gee' END AS source
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN ({nation_cities_sql()}) nc ON s.s_nationkey = nc.n_nationkey"""
