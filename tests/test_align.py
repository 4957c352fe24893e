"""E1 composite reduce and D1 nearest-date match on hand-made rows."""
import datetime as dt
import random

from pyspark.sql import functions as F

from citytherm.operators import align


def _d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def _samples(spark, rows):
    return spark.createDataFrame(rows, "city string, date date, pt string, v double, o int")


def test_composite_needs_both_sides(spark):
    rows = [("a", _d(0), "urban", None, 1), ("a", _d(0), "rural_0", 10.0, 2),
            ("a", _d(1), "urban", 30.0, 1),
            ("a", _d(2), "urban", 30.0, 1), ("a", _d(2), "rural_0", 27.0, 2)]
    out = align.composite_reduce(_samples(spark, rows), "city", "date", "pt", "v", "urban", order_col="o")
    got = {(r.date, r.urban, r.rural) for r in out.collect()}
    assert got == {(_d(2), 30.0, 27.0)}


def test_composite_median_of_valid_rural(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, None, None, None, None]
    rows = [("a", _d(0), "urban", 40.0, 0)] + [("a", _d(0), f"rural_{i}", v, i + 1) for i, v in enumerate(vals)]
    r = align.composite_reduce(_samples(spark, rows), "city", "date", "pt", "v", "urban", order_col="o").first()
    assert r.rural == 4.5  # mean of the middle two of 8


def _match(spark, left_days, right_days, method, tol=8, city_left="a", city_right="a"):
    left = spark.createDataFrame([(i, city_left, dt.datetime.combine(_d(d), dt.time(12))) for i, d in enumerate(left_days)],
                                 "id int, city string, ts timestamp_ntz")
    right = spark.createDataFrame([(city_right, _d(d), float(d)) for d in right_days], "city string, date date, u double")
    out = align.nearest_asof(left, right, "city", "ts", "date", ["u"], tolerance_days=tol, method=method)
    return {r.id: (r.match_date, r.u, r.gap_days) for r in out.collect()}


def test_nearest_tie_goes_to_earlier(spark):
    for m in ("blocks", "offsets", "window"):
        got = _match(spark, [4], [0, 8], m)
        assert got[0] == (_d(0), 0.0, 4), m


def test_nearest_tolerance_edge(spark):
    for m in ("blocks", "offsets", "window"):
        got = _match(spark, [8, 9], [0], m)
        assert got[0] == (_d(0), 0.0, 8), m
        assert got[1] == (None, None, None), m


def test_group_without_series_keeps_rows(spark):
    for m in ("blocks", "offsets", "window"):
        got = _match(spark, [1, 2], [1], m, city_right="b")
        assert got == {0: (None, None, None), 1: (None, None, None)}


def test_methods_agree_on_events(spark, smoke_dir):
    from citytherm.plans.queries import q_nearest_match, q_nearest_match_offsets, q_nearest_match_window
    a = q_nearest_match(spark, smoke_dir)
    for b in (q_nearest_match_window(spark, smoke_dir), q_nearest_match_offsets(spark, smoke_dir)):
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_blocks_agree_at_long_and_short_tolerances_with_a_hot_key(spark):
    rng = random.Random(4)
    left = [(i, "hot" if i % 3 else f"k{i % 7}", dt.datetime.combine(_d(rng.randint(-3000, 3000)), dt.time(6))) for i in range(900)] + [(900, None, None), (901, "hot", None)]
    right = {("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 7)}", _d(rng.randint(-3500, 3500))) for _ in range(160)}
    lf = spark.createDataFrame(left, "id int, city string, ts timestamp_ntz")
    rf = spark.createDataFrame([(k, d, float(i)) for i, (k, d) in enumerate(sorted(right))], "city string, date date, u double")
    for tol in (0, 1, 8, 33, 400):
        got = [sorted(map(str, align.nearest_asof(lf, rf, "city", "ts", "date", ["u"], tolerance_days=tol, method=m).collect()))
               for m in ("blocks", "offsets", "window")]
        assert got[0] == got[1] == got[2], tol


def test_fallback_union(spark):
    prim = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    fb = spark.createDataFrame([("a", 9), ("b", 8)], "k string, v int")
    out = align.fallback_union(prim, fb, "k")
    assert sorted((r.k, r.v, r.source) for r in out.collect()) == [
        ("a", 1, "primary"), ("a", 2, "primary"), ("b", 8, "fallback")]


def test_priority_first_non_null(spark):
    rows = [("x", 500, None), ("x", 1000, 1534), ("y", 500, None), ("y", 1000, None),
            ("y", 2000, None), ("y", 5000, None)]
    df = spark.createDataFrame(rows, "city string, scale int, raw int")
    out = align.first_by_priority(df, "city", "scale", "raw", [500, 1000, 2000, 5000], scale=10000.0,
                                  digits=4, out_value="ndvi", out_source="scale")
    assert [(r.city, r.scale, r.ndvi) for r in out.collect()] == [("x", 1000, 0.1534)]


def test_dedupe_and_latest(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("b", 5, "r")], "k string, o int, v string")
    first = {r.k: r.v for r in align.dedupe_first(df, "k", ["o"]).collect()}
    last = {r.k: r.v for r in align.latest_per_key(df, "k", ["o"]).collect()}
    assert first == {"a": "p", "b": "r"} and last == {"a": "q", "b": "r"}
    assert F is not None
