"""A1: the city dimension (name, lat, lon) and the probe-point plan (B1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# --------------------------------------------------------------------------
# The 25 cities: (name, latitude, longitude), in their configured order.
CITIES = [
    ("Delhi", 28.6139, 77.2090),
    ("Mumbai", 19.0760, 72.8777),
    ("New York", 40.7128, -74.0060),
    ("Los Angeles", 34.0522, -118.2437),
    ("London", 51.5074, -0.1278),
    ("Tokyo", 35.6762, 139.6503),
    ("Shanghai", 31.2304, 121.4737),
    ("São Paulo", -23.5505, -46.6333),
    ("Cairo", 30.0444, 31.2357),
    ("Lagos", 6.5244, 3.3792),
    ("Jakarta", -6.2088, 106.8456),
    ("Mexico City", 19.4326, -99.1332),
    ("Karachi", 24.8607, 67.0011),
    ("Beijing", 39.9042, 116.4074),
    ("Dhaka", 23.8103, 90.4125),
    ("Bangkok", 13.7563, 100.5018),
    ("Kolkata", 22.5726, 88.3639),
    ("Chicago", 41.8781, -87.6298),
    ("Paris", 48.8566, 2.3522),
    ("Istanbul", 41.0082, 28.9784),
    ("Sydney", -33.8688, 151.2093),
    ("Toronto", 43.6532, -79.3832),
    ("Singapore", 1.3521, 103.8198),
    ("Berlin", 52.5200, 13.4050),
    ("Seoul", 37.5665, 126.9780),
]
# Probe offsets (dlat, dlon) in degrees for the 12 reference points around
# each city, tagged rural_0 .. rural_11; the city itself is tagged urban.
RURAL_OFFSETS = [
    (0.5, 0.0), (-0.5, 0.0), (0.0, 0.5), (0.0, -0.5),
    (0.5, 0.5), (-0.5, 0.5), (-0.5, -0.5), (0.5, -0.5),
    (1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.0, -1.0),
]

CITY_SCHEMA = T.StructType([
    T.StructField("city_pos", T.IntegerType(), False),
    T.StructField("city", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
])


def city_frame(spark: SparkSession, names: Sequence[str] | None = None,
               first_n: int | None = None) -> DataFrame:
    """The city list as a 25-row DataFrame (a proven-small broadcast side).

    ``first_n`` / ``names`` select a subset like a partial refresh does.
    """
    rows = [(i + 1, n, la, lo) for i, (n, la, lo) in enumerate(CITIES)]
    if first_n is not None:
        rows = rows[:first_n]
    if names is not None:
        keep = set(names)
        rows = [r for r in rows if r[1] in keep]
    return spark.createDataFrame(rows, CITY_SCHEMA)


def probe_offsets_column():
    """Array of (pt, dlat, dlon) structs: urban first, then the 12 offsets."""
    items = [F.struct(F.lit("urban").alias("pt"), F.lit(0.0).alias("dlat"), F.lit(0.0).alias("dlon"))]
    for i, (dlat, dlon) in enumerate(RURAL_OFFSETS):
        items.append(F.struct(F.lit(f"rural_{i}").alias("pt"), F.lit(dlat).alias("dlat"),
                              F.lit(dlon).alias("dlon")))
    return F.array(*items)


def probe_points(sites: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """B1: 13 probe points per site: (pt, probe_lat, probe_lon)."""
    return (sites.select("*", F.inline(probe_offsets_column()))
            .withColumn("probe_lat", F.col(lat) + F.col("dlat"))
            .withColumn("probe_lon", F.col(lon) + F.col("dlon"))
            .drop("dlat", "dlon"))
