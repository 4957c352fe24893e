"""The end-to-end job: landed payloads -> raw table -> processed table ->
trained model and reports, with a stage table between steps (A6-A10).

    python -m citytherm.plans.pipeline --landing DIR --out DIR [--asof YYYY-MM-DD]
        [--profile fast|full] [--force]

Landing folder layout (JSON lines, schemas in ``sources.payloads``):
``weather_daily/``, ``weather_current/``, ``surface/``, ``vegetation/``.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.functions.expressions import clip, round_half_even
from citytherm.operators import align, features, learn, preprocess
from citytherm.sources import payloads, stages
from citytherm.sources.cities import city_frame

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# --------------------------------------------------------------------------
WINDOW_DAYS = 180          # collection window length
WINDOW_LAG_DAYS = 30       # window ends this many days before the as-of date
MATCH_TOLERANCE_DAYS = 8   # one composite period
VEGETATION_YEAR = ("2023-01-01", "2023-12-31")
SOURCE_TAG = "openmeteo+gee"


@dataclass
class Paths:
    out: str

    @property
    def raw(self):
        return f"{self.out}/raw"

    @property
    def processed(self):
        return f"{self.out}/processed"

    @property
    def outliers(self):
        return f"{self.out}/reports/outliers"

    @property
    def model(self):
        return f"{self.out}/model"

    def report(self, name):
        return f"{self.out}/reports/{name}"


def window(asof: str) -> tuple[str, str]:
    """C4: 180 days up to 30 days before the as-of date: first and last day.
    Daily weather includes the last day; surface composites end before it."""
    end = dt.date.fromisoformat(asof) - dt.timedelta(days=WINDOW_LAG_DAYS)
    start = end - dt.timedelta(days=WINDOW_DAYS - 1)
    return start.isoformat(), end.isoformat()


def collect(spark: SparkSession, landing: str, asof: str, cities: DataFrame | None = None,
            zero_is_missing: bool = False) -> DataFrame:
    """Entry 1, step 1: the raw observation table (14 columns).

    vegetation (A4) -> urban fraction; surface samples (A5) -> composites
    (E1); daily weather (A2), else the current reading (A3, D3); city
    constants attached (D2; a city without vegetation is skipped); every
    row matched to the nearest composite within 8 days (D1).
    """
    cities = cities if cities is not None else city_frame(spark)
    start, end = window(asof)
    veg = payloads.vegetation_index(
        payloads.read_payloads(spark, f"{landing}/vegetation", payloads.VEGETATION_SCHEMA),
        VEGETATION_YEAR[0], VEGETATION_YEAR[1])
    consts = veg.select(F.col("city").alias("name"), "ndvi",
                        round_half_even(clip(F.lit(1.0) - F.col("ndvi"), 0.0, 1.0), 3).alias("urban_fraction"))
    surf = payloads.surface_readings(
        payloads.read_payloads(spark, f"{landing}/surface", payloads.SURFACE_SCHEMA)
        .where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date"))))
    comp = align.composite_reduce(surf, "city", "date", "pt", "lst", "urban", digits=3,
                                  urban_name="urban_lst", rural_name="rural_lst")
    daily = payloads.daily_rows(
        payloads.read_payloads(spark, f"{landing}/weather_daily", payloads.DAILY_SCHEMA), zero_is_missing)
    daily = daily.where(F.col("time").between(start, end)).drop("time")
    current = payloads.current_row(
        payloads.read_payloads(spark, f"{landing}/weather_current", payloads.CURRENT_SCHEMA), zero_is_missing)
    weather = align.fallback_union(daily, current.select(*daily.columns), "name", tag_col=None)
    dims = cities.select(F.col("city").alias("name"), "lat", "lon")
    rows = (weather.join(F.broadcast(dims), "name")          # bounded city list
                   .withColumn("_date", F.to_date(F.substring("timestamp", 1, 10))))
    rows = align.attach_constants(rows, consts, "name")  # D2, inner: no vegetation -> skipped
    matched = align.nearest_asof(rows, comp.withColumnRenamed("city", "name"), "name", "_date", "date",
                                 ["urban_lst", "rural_lst"], tolerance_days=MATCH_TOLERANCE_DAYS)
    return matched.select("name", "lat", "lon", "temperature", "humidity", "wind_speed", "pressure",
                          F.col("clouds").cast("int").alias("clouds"), "timestamp", "ndvi", "urban_fraction",
                          "urban_lst", "rural_lst", F.lit(SOURCE_TAG).alias("source"))


@dataclass
class Outcome:
    best_model: str
    best_pipeline: PipelineModel
    run: DataFrame
    model_metric: DataFrame
    feature_importance: DataFrame
    assignment: DataFrame
    did: tuple[str, ...]  # the steps that ran; the others were taken from earlier output


REPORTS = ("run", "model_metric", "feature_importance", "assignment")


def run_pipeline(spark: SparkSession, landing: str, out: str, asof: str | None = None,
                 profile: str = "fast", models=None, force: bool = False,
                 fit_scope: str = "train", cities: DataFrame | None = None) -> Outcome:
    """collect -> raw stage -> preprocess -> processed stage -> train -> model
    and reports.  A step whose output exists is not run unless ``force``; a step
    that runs replaces its output and reports.  ``cities`` limits a collection to a subset."""
    p = Paths(out.rstrip("/"))
    did = []
    if force or not stages.exists(spark, p.raw):
        did.append("collect")
        stages.write_stage(collect(spark, landing, asof or dt.date.today().isoformat(), cities), p.raw, force=True)
        if spark.read.parquet(p.raw).isEmpty():
            raise RuntimeError("no data collected")
    if force or did or not stages.exists(spark, p.processed):
        did.append("preprocess")
        prep = preprocess.preprocess(spark.read.parquet(p.raw), require_rows=True)
        stages.write_stage(prep.outliers, p.outliers, force=True)
        names = spark.createDataFrame(list(enumerate(prep.feature_names, 1)), "position int, feature string")
        stages.write_stage(names, p.report("features"), force=True)
        stages.write_stage(prep.table, p.processed, force=True)
    if force or did or not stages.exists(spark, p.report("run")):
        did.append("train")
        names = [r["feature"] for r in spark.read.parquet(p.report("features")).orderBy("position").collect()]
        res = learn.train_models(spark.read.parquet(p.processed), names, features.TARGET_COLUMN, features.GROUP_COLUMN,
                                 profile=profile, models=models, fit_scope=fit_scope)
        res.best_pipeline.write().overwrite().save(p.model)
        for name in reversed(REPORTS):  # the run row last: it says that the others are there
            stages.write_stage(getattr(res, name), p.report(name), force=True)
    reports = {name: spark.read.parquet(p.report(name)) for name in REPORTS}
    return Outcome(reports["run"].first()["best_model"], PipelineModel.load(p.model), **reports, did=tuple(did))


def main() -> None:
    from citytherm.session import get_session
    ap = argparse.ArgumentParser()
    ap.add_argument("--landing", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--asof", default=None)
    ap.add_argument("--profile", default="fast", choices=["fast", "full"])
    ap.add_argument("--force", action="store_true")
    a = ap.parse_args()
    spark = get_session()
    res = run_pipeline(spark, a.landing, a.out, a.asof, a.profile, force=a.force)
    res.run.show(truncate=False)


if __name__ == "__main__":
    main()
