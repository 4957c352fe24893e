"""Registered queries over the shared test tables.

Each function takes (spark, sf_dir) and returns a lazy DataFrame that reads
whole tables.  Float outputs of checked queries are rounded (half to even)
to ``CHECK_DIGITS`` so that last-bit differences between engines vanish;
the operators themselves never round unless the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.operators import align, profile, target
from citytherm.plans.common import (MATCH_TOLERANCE_DAYS, REFERENCE_TYPE, events_samples, rnd)
from citytherm.sources.stages import materialize
from citytherm.sources.tables import Tables

from citytherm.plans.registry import REGISTRY


def register(fn):
    REGISTRY[fn.__name__.removeprefix("q_")] = fn
    return fn


# --------------------------------------------------------------------------
# The minimum slice: E1 -> D1 -> E28 -> E5 -> E7
# --------------------------------------------------------------------------
def _composite(t: Tables) -> DataFrame:
    return align.composite_reduce(events_samples(t), "user_id", "day", "event_type", "value",
                                  REFERENCE_TYPE, order_col="ord", digits=3)


def _matched(t: Tables, method: str = "blocks") -> DataFrame:
    return align.nearest_asof(t.events.select("event_id", "user_id", "ts"), _composite(t), "user_id", "ts", "day",
                              ["urban", "rural"], tolerance_days=MATCH_TOLERANCE_DAYS,
                              method=method)


def _contrast(t: Tables) -> DataFrame:
    """E5 over the matched rows, written once as a stage (the reference's raw
    table): the target's main path, group medians and global median then
    read that stage instead of re-running the reduce and the match."""
    matched = materialize(_matched(t), "matched")
    return target.contrast_target(matched, "urban", "rural", "user_id", out="contrast")


@register
def q_composite_reduce(spark: SparkSession, sf: str) -> DataFrame:
    return _composite(Tables(spark, sf))


@register
def q_nearest_match(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(Tables(spark, sf))


@register
def q_nearest_match_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(Tables(spark, sf), method="offsets")


@register
def q_nearest_match_window(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(Tables(spark, sf), method="window")


@register
def q_match_coverage(spark: SparkSession, sf: str) -> DataFrame:
    cov = align.match_coverage(_matched(Tables(spark, sf)), "user_id", "urban")
    return cov.withColumn("coverage", rnd("coverage"))


@register
def q_contrast_target(spark: SparkSession, sf: str) -> DataFrame:
    return _contrast(Tables(spark, sf)).select("event_id", "user_id", "contrast")


@register
def q_group_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """E7 on the contrast.  The contrast has 3 decimals, so it is aggregated
    in thousandths (whole numbers: their double sums are exact in any order)
    and scaled back; a mean like x.xxxxxx5 then rounds the same in every
    engine and partitioning."""
    c = _contrast(Tables(spark, sf)).withColumn("milli", F.rint(F.col("contrast") * 1000.0))
    r = profile.group_ranking(c, "user_id", "milli")
    return r.select("user_id", rnd(F.col("mean") / 1000.0).alias("mean"),
                    rnd(F.col("std") / 1000.0).alias("std"),
                    (F.col("min") / 1000.0).alias("min"), (F.col("max") / 1000.0).alias("max"), "n")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The slice end to end: users ranked by mean contrast, highest first."""
    r = q_group_ranking(spark, sf)
    return r.orderBy(F.col("mean").desc(), F.col("user_id"))
