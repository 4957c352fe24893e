"""Entry 1 end to end on hand-made landed payloads (3 cities)."""
import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from citytherm.plans import pipeline

ASOF = "2024-03-01"


def _write(folder, name, objs):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")


def _landing():
    root = tempfile.mkdtemp(prefix="citytherm-landing-")  # test-only local folder
    start, end = pipeline.window(ASOF)
    d0 = dt.date.fromisoformat(start)
    days = [(d0 + dt.timedelta(days=i)).isoformat() for i in range(0, 60)]
    daily = []
    for ci, city in enumerate(["Delhi", "Mumbai"]):
        daily.append({"city": city, "daily": {
            "time": days,
            "temperature_2m_mean": [20.0 + ci + (i % 7) for i in range(60)],
            "relative_humidity_2m_mean": [50.0 + (i % 5) for i in range(60)],
            "wind_speed_10m_max": [10.0 + (i % 3) for i in range(60)],
            "surface_pressure_mean": [1010.0 for _ in range(60)],
            "cloud_cover_mean": [float(i % 90) for i in range(60)]}})
    _write(f"{root}/weather_daily", "a", daily)
    # London has no daily payload: its current reading is the fallback row
    _write(f"{root}/weather_current", "a", [
        {"city": "London", "main": {"temp": 12.0, "humidity": 80.0, "pressure": 1000.0},
         "wind": {"speed": 4.0}, "clouds": {"all": 75}, "dt": 1704110400},
        {"city": "Delhi", "main": {"temp": 30.0, "humidity": 20.0, "pressure": 1005.0},
         "wind": {"speed": 1.0}, "clouds": {"all": 0}, "dt": 1704110400}])
    surf = []
    for city in ["Delhi", "Mumbai", "London"]:
        for k in range(0, 40, 8):  # composites every 8 days over the first 40 days only
            date = (d0 + dt.timedelta(days=k)).isoformat()
            surf.append({"city": city, "pt": "urban", "date": date, "dn": 15200 + k})
            for j in range(12):
                surf.append({"city": city, "pt": f"rural_{j}", "date": date, "dn": 15000 + j})
    _write(f"{root}/surface", "a", surf)
    veg = [{"city": "Delhi", "date": "2023-05-01", "scale": 500, "raw": 2000},
           {"city": "Mumbai", "date": "2023-05-01", "scale": 500, "raw": None},
           {"city": "Mumbai", "date": "2023-05-01", "scale": 1000, "raw": 4000},
           {"city": "London", "date": "2023-05-01", "scale": 500, "raw": 3000}]
    _write(f"{root}/vegetation", "a", veg)
    return root


def test_collect_and_run(spark):
    landing = _landing()
    raw = pipeline.collect(spark, landing, ASOF)
    by_city = {r.name: r.n for r in raw.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by_city == {"Delhi": 60, "Mumbai": 60, "London": 1}
    m = {r.name: r.ndvi for r in raw.select("name", "ndvi").distinct().collect()}
    assert m == {"Delhi": 0.2, "Mumbai": 0.4, "London": 0.3}
    # composites cover days 0..32; rows more than 8 days after day 32 stay unmatched
    unmatched = raw.where("name = 'Delhi' AND urban_lst IS NULL").count()
    assert unmatched == 60 - 41
    out = tempfile.mkdtemp(prefix="citytherm-out-")
    res = pipeline.run_pipeline(spark, landing, out, ASOF, profile="fast",
                                models=["Linear Regression", "Ridge Regression"], force=True)
    assert res.best_model in ("Linear Regression", "Ridge Regression")
    proc = spark.read.parquet(f"{out}/processed")
    assert len([c for c in proc.columns if c not in ("uhi_intensity", "city_name")]) == 27
    assert spark.read.parquet(f"{out}/reports/model_metric").count() == 2
    assert res.did == ("collect", "preprocess", "train")
    # a second run takes everything from the first one
    again = pipeline.run_pipeline(spark, landing, out, ASOF, models=["Linear Regression"])
    assert again.did == () and again.best_model == res.best_model and again.model_metric.count() == 2
    # a forced run replaces the reports, and reports read back as written
    forced = pipeline.run_pipeline(spark, landing, out, ASOF, models=["Linear Regression"], force=True)
    assert spark.read.parquet(f"{out}/reports/model_metric").count() == 1 and forced.run.count() == 1
    assert [r.feature for r in spark.read.parquet(f"{out}/reports/features").orderBy("position").collect()] == forced.run.first()["feature_names"]
    assert spark.read.parquet(f"{out}/reports/outliers").count() > 0
    proc = spark.read.parquet(f"{out}/processed")
    a = forced.best_pipeline.transform(proc).select("prediction").toPandas()
    assert len(a) == proc.count()


def test_surface_window_excludes_its_last_day_and_city_subset(spark):
    landing = _landing()
    start, end = pipeline.window(ASOF)
    _write(f"{landing}/weather_daily", "a", [{"city": "Delhi", "daily": {
        "time": [end], "temperature_2m_mean": [20.0], "relative_humidity_2m_mean": [50.0], "wind_speed_10m_max": [9.0],
        "surface_pressure_mean": [1010.0], "cloud_cover_mean": [1.0]}}])
    _write(f"{landing}/surface", "a", [{"city": "Delhi", "pt": p, "date": end, "dn": 15000} for p in ("urban", "rural_0")])
    from citytherm.sources.cities import city_frame
    raw = pipeline.collect(spark, landing, ASOF, cities=city_frame(spark, names=["Delhi"])).collect()
    assert [(r["name"], r["urban_lst"]) for r in raw] == [("Delhi", None)]
