"""Incremental ingest: payload files landed in two batches are appended once each."""
import json
import tempfile

from citytherm.streaming import start_daily_ingest


def _land(folder, name, city, days):
    payload = {"city": city, "daily": {
        "time": [f"2024-01-{d:02d}" for d in days],
        "temperature_2m_mean": [20.0 + d for d in days],
        "relative_humidity_2m_mean": [50.0 for _ in days],
        "wind_speed_10m_max": [7.2 for _ in days]}}
    with open(f"{folder}/{name}.json", "w") as f:
        f.write(json.dumps(payload) + "\n")


def test_incremental_ingest(spark):
    root = tempfile.mkdtemp(prefix="citytherm-stream-")  # test-only local folder
    landing, raw, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/ckpt"
    import os
    os.makedirs(landing)
    _land(landing, "a", "Paris", [1, 2, 3])
    start_daily_ingest(spark, landing, raw, ckpt).awaitTermination()
    assert spark.read.parquet(raw).count() == 3
    _land(landing, "b", "Berlin", [1, 2])
    start_daily_ingest(spark, landing, raw, ckpt).awaitTermination()
    df = spark.read.parquet(raw)
    assert df.count() == 5
    r = df.where("name = 'Berlin'").orderBy("time").first()
    assert (r.wind_speed, r.pressure, r.clouds, r.timestamp) == (2.0, 1013.0, 50, "2024-01-01T12:00:00")
