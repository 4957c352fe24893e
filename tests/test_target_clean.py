"""E5 target fallbacks, E2/E3 fences, C1/C2 filters, B5/E4, on hand-made rows."""
import pytest
from pyspark.sql import functions as F

from citytherm.functions import stats
from citytherm.operators import clean, preprocess, target
from citytherm.sources import stages


def test_contrast_fallbacks(spark):
    rows = [("g", 30.0, 32.0), ("g", 30.0, 27.0), ("g", None, 1.0),
            ("h", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "name string, u double, r double")
    out = [r.uhi_intensity for r in target.contrast_target(df, "u", "r", "name").collect()]
    # pairs: 0 and 3; group g median 1.5; h and the null group take the global median 1.5
    assert sorted(out) == [0.0, 1.5, 1.5, 1.5, 3.0]


def test_contrast_all_missing_stays_null(spark):
    df = spark.createDataFrame([("g", None, None)], "name string, u double, r double")
    assert target.contrast_target(df, "u", "r", "name").first().uhi_intensity is None


def test_fences_and_winsorize(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x double")
    rep = clean.outlier_report(df, ["x"]).first()
    assert (rep.q1, rep.q3, rep.lower_fence, rep.upper_fence) == (2.0, 4.0, -1.0, 7.0)
    assert (rep.n_low, rep.n_high, rep.n_capped, rep.pct) == (0, 1, 1, 20.0)
    capped = sorted(r.x for r in clean.winsorize(df, ["x"]).collect())
    assert capped == [1.0, 2.0, 3.0, 4.0, 7.0]


def test_range_filter_edges(spark):
    df = spark.createDataFrame([(-60.0,), (60.0,), (60.1,), (None,)], "temperature double")
    kept = sorted(r.temperature for r in clean.range_filter(df).collect())
    assert kept == [-60.0, 60.0]


def test_source_filter_null(spark):
    df = spark.createDataFrame([("openmeteo+gee",), ("manual",), (None,), ("x-openweather",)], "source string")
    assert sorted(r.source for r in clean.source_filter(df, "source").collect()) == ["openmeteo+gee", "x-openweather"]


def test_inject_and_impute(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "temperature double")
    d = clean.inject_defaults(df)
    assert {"humidity", "urban_lst", "clouds"} <= set(d.columns)
    assert dict(d.dtypes)["clouds"] == "int" and dict(d.dtypes)["urban_lst"] == "double"
    imp = clean.median_impute(df, ["temperature"])
    assert sorted(r.temperature for r in imp.collect()) == [1.0, 3.0, 3.0, 10.0]


def test_two_phase_quantiles_match_direct(spark, smoke_dir):
    from pyspark.sql import functions as F
    from citytherm.functions.stats import wide_quantiles
    e = spark.read.parquet(f"{smoke_dir}/events.parquet")
    w = wide_quantiles(e, ["value"], [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    d = e.agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).first().q
    assert [w.value__a, w.value__b, w.value__c] == d


def test_integer_median_keeps_its_half(spark):
    df = spark.createDataFrame([(10,), (15,), (None,)], "clouds int")
    assert sorted(r.clouds for r in clean.median_impute(df, ["clouds"]).collect()) == [10.0, 12.5, 15.0]


def _raw(spark):
    rows = [(f"g{i % 3}" if i % 7 else None, 10.0 + i % 9, 40.0 + i % 5, 3.0, 1000.0, 0.3, 0.5, 1.0 + i % 3, 2.0,
             30.0 + i % 4 if i % 5 else None, 28.0 + i % 3, "openweather", "2024-03-01 10:00:00") for i in range(90)]
    return spark.createDataFrame(rows, "name string, temperature double, humidity double, wind_speed double, pressure double, ndvi double, "
                                       "urban_fraction double, lat double, lon double, urban_lst double, rural_lst double, source string, timestamp string")


def test_preprocess_fits_fences_once_and_medians_before_features(spark, monkeypatch):
    written, fitted = [], []
    keep, median = preprocess.materialize, target.group_median
    monkeypatch.setattr(preprocess, "materialize", lambda df, name="stage": written.append(name) or keep(df, name))
    monkeypatch.setattr(target, "group_median", lambda df, *a: fitted.append(df.columns) or median(df, *a))
    out = preprocess.preprocess(_raw(spark))
    assert "fences" in written  # one row, read back by all later passes
    assert fitted and "heat_index" not in fitted[0]
    assert out.table.count() == 90


def test_contrast_medians_fitted_on_another_frame(spark):
    df = spark.createDataFrame([("g", 30.0, 27.0), ("g", None, 1.0), ("h", None, 1.0)], "name string, u double, r double")
    other = spark.createDataFrame([("g", 9.0, 2.0), ("h", 5.0, 0.0)], "name string, u double, r double")
    out = target.contrast_target(df, "u", "r", "name", fit_on=other).collect()
    assert sorted(r.uhi_intensity for r in out) == [3.0, 5.0, 7.0]


@pytest.mark.parametrize("rows", [10, 20_001])
def test_group_sizes_of_quantiles_are_counted_once(spark, monkeypatch, rows):
    written, keep = [], stages.materialize
    monkeypatch.setattr(stages, "materialize", lambda df, name="stage": written.append(name) or keep(df, name))
    df = spark.range(rows).select(F.lit("g").alias("k"), F.col("id").cast("double").alias("x"))
    assert stats.group_median(df, "k", "x", "m").first().m == (rows - 1) / 2
    assert written.count("sizes") == 1
