"""B6-B12, B14-B17, E6, E12 edge rows."""
from pyspark.sql import functions as F

from citytherm.functions import expressions as X
from citytherm.operators import features, profile


def test_bad_timestamp_defaults(spark):
    df = spark.createDataFrame([("bad", 20.0, 50.0, 1.0, 0.3, 0.5, 10.0, 20.0, "a"),
                                ("2024-03-05T05:00:00", 20.0, 50.0, 1.0, 0.3, 0.5, 10.0, 20.0, "a")],
                               "timestamp string, temperature double, humidity double, wind_speed double, "
                               "ndvi double, urban_fraction double, lat double, lon double, name string")
    out = features.engineer_features(df).select("hour", "month", "is_daytime", "is_night").collect()
    assert (out[0].hour, out[0].month) == (12, 6)
    assert (out[1].hour, out[1].month, out[1].is_daytime, out[1].is_night) == (5, 3, 0, 1)


def test_day_night_flags(spark):
    df = spark.createDataFrame([(h,) for h in (5, 6, 18, 19)], "h int")
    got = [(r.d, r.n) for r in df.select(X.is_daytime("h").alias("d"), X.is_night("h").alias("n")).collect()]
    assert got == [(0, 1), (1, 0), (1, 0), (0, 1)]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.2, 0.2001, 0.5, 0.51, -1.0, None)], "x double")
    got = [r.b for r in df.select(X.right_closed_bin("x").alias("b")).collect()]
    assert got == [0, 1, 1, 2, 0, None]


def test_cooling_zero_below_base(spark):
    df = spark.createDataFrame([(10.0, 3.0), (25.0, 2.0)], "t double, w double")
    got = [r.c for r in df.select(X.wind_cooling_effect("w", "t").alias("c")).collect()]
    assert got == [0.0, 10.0]


def test_anomaly_null_group(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), (None, 5.0)], "g string, t double")
    got = {(r.g, r.an) for r in features.group_anomaly(df, "g", "t", "an").collect()}
    assert got == {("a", -5.0), ("a", 5.0), (None, None)}


def test_pivot_missing_month_is_zero(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 1, 6.0)], "g string, m int, v double")
    p = {r.g: r for r in profile.pivot_month(df, "g", "m", "v").collect()}
    assert p["b"].Feb == 0.0 and p["a"].Feb == 4.0 and p["a"].Dec == 0.0
    present = profile.pivot_month(df, "g", "m", "v", months="present")
    assert present.columns == ["g", "Jan", "Feb"]


def test_severity_score_cuts(spark):
    df = spark.createDataFrame([(v,) for v in (0.99, 1.0, 2.0, 3.0, 4.0)], "x double")
    got = [r.s for r in df.select(X.severity_score("x").alias("s")).collect()]
    assert got == ["Low", "Moderate", "High", "High", "Extreme"]


def test_minmax_constant_set(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, 0.0, 4.0)], "x double, lo double, hi double")
    got = [r.n for r in df.select(X.minmax_normalise("x", "lo", "hi").alias("n")).collect()]
    assert got[0] == 0.5 and abs(got[1] - 0.5) < 1e-9


def test_round_half_even_matches_numpy(spark):
    import numpy as np
    vals = [0.0005, 0.0015, 0.0025, 1.2345, 2.675, -0.0035, 1234.5675]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(X.round_half_even("x", 3).alias("y")).collect()]
    assert got == [float(np.round(v, 3)) for v in vals]


def test_histogram_counts_sum(spark, smoke_dir):
    e = spark.read.parquet(f"{smoke_dir}/events.parquet")
    h = profile.histogram(e, "value", 40)
    assert h.count() == 40
    assert h.agg(F.sum("n")).first()[0] == e.where(F.col("value").isNotNull()).count()
