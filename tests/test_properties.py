"""Properties from SURVEY section 5 on the shared test tables (sf0.001)."""
from pyspark.sql import functions as F

from citytherm.operators import clean, evaluate, features, profile, split


def _events(spark, smoke_dir):
    return spark.read.parquet(f"{smoke_dir}/events.parquet")


def test_winsorised_inside_fences_and_rows_kept(spark, smoke_dir):
    e = _events(spark, smoke_dir)
    f = clean.fit_fences(e, ["value"]).first()
    w = clean.winsorize(e, ["value"])
    assert w.count() == e.count()
    lo, hi = w.agg(F.min("value"), F.max("value")).first()
    assert f["value__lo"] <= lo and hi <= f["value__hi"]


def test_anomaly_sums_to_zero_per_group(spark, smoke_dir):
    e = _events(spark, smoke_dir)
    a = features.group_anomaly(e, "user_id", "value", "an", digits=None)
    worst = a.groupBy("user_id").agg(F.abs(F.sum("an")).alias("s")).agg(F.max("s")).first()[0]
    assert worst < 1e-6


def test_baseline_r2_not_positive_on_test(spark, smoke_dir):
    o = spark.read.parquet(f"{smoke_dir}/orders.parquet")
    c = spark.read.parquet(f"{smoke_dir}/customer.parquet")
    d = o.join(c, o.o_custkey == c.c_custkey)
    d = split.attach(d, split.group_holdout(d, "c_nationkey"), "c_nationkey")
    p = evaluate.baseline_predictions(d.where("split = 'train'"), d.where("split = 'test'"), "o_totalprice")
    assert evaluate.regression_metrics(p, "o_totalprice", "pred").first().r2 <= 1e-12


def test_pivot_equals_long_aggregate(spark, smoke_dir):
    e = _events(spark, smoke_dir).withColumn("m", F.month("ts"))
    wide = {r.user_id: r for r in profile.pivot_month(e, "user_id", "m", "value").collect()}
    for r in profile.monthly_mean(e, "user_id", "m", "value").collect():
        assert abs(getattr(wide[r.user_id], r.month_name) - r.mean) < 1e-9


def test_no_group_in_both_splits(spark, smoke_dir):
    e = _events(spark, smoke_dir)
    a = split.group_holdout(e, "user_id", 0.2, 7)
    tr = a.where("split = 'train'").select("user_id")
    te = a.where("split = 'test'").select("user_id")
    assert tr.intersect(te).count() == 0
    assert tr.count() + te.count() == e.select("user_id").distinct().count()
