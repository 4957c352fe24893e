"""Reduce tagged samples to a reference series and align rows to it.

E1 composite reduce, D1 nearest-date as-of join, D2 attach per-group
constants, D3 primary-else-fallback union, E28 match coverage, A4 first
non-null source in priority order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citytherm.functions.expressions import round_half_even
from citytherm.functions.stats import join_null_safe, quantiles


def _cols(cs: str | Sequence[str]) -> list[str]:
    return [cs] if isinstance(cs, str) else list(cs)


# --------------------------------------------------------------------------
# E1
# --------------------------------------------------------------------------
def composite_reduce(samples: DataFrame, keys: str | Sequence[str], date_col: str,
                     tag_col: str, value_col: str, reference_tag: str,
                     order_col: str | None = None, digits: int | None = 3,
                     urban_name: str = "urban", rural_name: str = "rural") -> DataFrame:
    """One row per (keys, date): the reference-tag value vs the median of the rest.

    ``urban`` is the last reference sample (by ``order_col``, ties and a
    missing ``order_col``: the largest value), ``rural`` the exact median of the
    other samples; dates lacking either are dropped.  Null dates / values are
    dropped first (C3).  Both sides are partial aggregates combined map-side;
    the median narrows value ranges (``functions.stats``), so a (key, date)
    with very many samples is never one buffer.
    """
    keys = _cols(keys)
    s = samples.where(F.col(date_col).isNotNull() & F.col(value_col).isNotNull())
    is_ref = F.col(tag_col) == F.lit(reference_tag)
    order = F.struct(*([F.col(order_col)] if order_col else []), F.col(value_col))
    urban = s.where(is_ref).groupBy(*keys, date_col).agg(F.max_by(value_col, order).alias(urban_name))
    other = s.where(~is_ref).select(*keys, date_col, F.col(value_col).alias("_other"))
    rural = (quantiles(other, ["_other"], [0.5], keys=[*keys, date_col])
             .select(*keys, date_col, F.col("q")[0].alias(rural_name)))
    out = (join_null_safe(urban, rural, [*keys, date_col])
           .where(F.col(urban_name).isNotNull() & F.col(rural_name).isNotNull()))
    if digits is not None:
        out = out.select(*keys, date_col,
                         round_half_even(urban_name, digits).alias(urban_name),
                         round_half_even(rural_name, digits).alias(rural_name))
    return out


# --------------------------------------------------------------------------
# D1
# --------------------------------------------------------------------------
MIN_BLOCK_DAYS = 32


def nearest_asof(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                 left_time: str, right_date: str, value_cols: Sequence[str],
                 tolerance_days: int = 8, method: str = "blocks",
                 match_date_name: str = "match_date", gap_name: str = "gap_days") -> DataFrame:
    """Attach to each left row the right row of the same key nearest in days.

    Semantics: smallest |days|; a tie goes to the earlier right date; a gap
    above ``tolerance_days`` (or no right row) gives nulls and keeps the row.

    Plan: the match depends only on (key, day), so it is computed on the
    distinct (key, day) calendar of the left side -- bounded by keys x days,
    not by rows -- and joined back.  A key holding a third of all rows then
    costs a map-side dedupe plus a join that AQE can split or broadcast.

    ``method="blocks"``: calendar and right dates of a key are cut into blocks of
    at least ``tolerance_days`` days.  A window inside (key, block), which holds at most
    two rows a day of the block, carries the right row before and after each day;
    a day without one in its block takes the last of the block before or the
    first of the block after from a table with one row per (key, block), and a match
    never lies further off.  No probes grow with the tolerance and no task holds a
    key's calendar.  ``method="offsets"``: each calendar day probes day-tol..day+tol with an
    equi-join on (key, date) (right is unique per key/date) and keeps the
    best by (|gap|, date).  ``method="window"``: union calendar and right,
    carry the previous/next right row with ``last(..., ignorenulls)`` over a
    growing frame of the key, pick the nearer.  Each implementation checks the others.
    """
    keys = _cols(keys)
    tol = int(tolerance_days)
    rvals = list(value_cols)
    day = F.to_date(F.col(left_time))
    cal = left.select(*keys, day.alias("_day")).where(F.col("_day").isNotNull()).distinct()
    r = right.select(*keys, F.col(right_date).cast("date").alias("_rdate"), *rvals)

    if method == "offsets":
        cand = (cal.withColumn("_off", F.explode(F.sequence(F.lit(-tol), F.lit(tol))))
                   .withColumn("_rdate", F.date_add(F.col("_day"), F.col("_off"))))
        j = cand.join(r, keys + ["_rdate"], "inner")
        best = (j.groupBy(*keys, "_day")
                 .agg(F.min_by(F.struct(F.col("_rdate").alias("d"), *[F.col(v) for v in rvals]),
                               F.struct(F.abs(F.col("_off")), F.col("_rdate"))).alias("_m")))
        match = best.select(*keys, "_day",
                            F.col("_m.d").alias(match_date_name),
                            *[F.col(f"_m.{v}").alias(v) for v in rvals])
    elif method in ("blocks", "window"):
        payload = F.struct(F.col("_rdate").alias("d"), *[F.col(v) for v in rvals])
        days = max(tol, MIN_BLOCK_DAYS)
        # one block for a whole key in the plain window
        block = (F.floor(F.datediff(F.col("_t"), F.lit("1970-01-01").cast("date")) / days).cast("int") if method == "blocks" else F.lit(0)).alias("_block")
        rows = r.where(F.col("_rdate").isNotNull()).select(*keys, F.col("_rdate").alias("_t"), payload.alias("_p")).select(*keys, "_t", block, F.lit(0).alias("_side"), "_p")
        u = (cal.select(*keys, F.col("_day").alias("_t")).select(*keys, "_t", block, F.lit(1).alias("_side"), F.lit(None).cast(rows.schema["_p"].dataType).alias("_p"))
             .unionByName(rows))
        grow = (Window.unboundedPreceding, Window.currentRow)
        w_prev = Window.partitionBy(*keys, "_block").orderBy(F.col("_t").asc(), F.col("_side").asc()).rowsBetween(*grow)
        w_next = Window.partitionBy(*keys, "_block").orderBy(F.col("_t").desc(), F.col("_side").asc()).rowsBetween(*grow)
        u = (u.withColumn("_prev", F.last("_p", ignorenulls=True).over(w_prev))
              .withColumn("_next", F.last("_p", ignorenulls=True).over(w_next))
              .where(F.col("_side") == 1))
        if method == "blocks":
            # one row per (key, block): its first and last right rows, for the blocks beside it
            ends = rows.groupBy(*keys, "_block").agg(F.max_by("_p", "_t").alias("_last"), F.min_by("_p", "_t").alias("_first"))
            before = ends.select(*keys, (F.col("_block") + 1).alias("_block"), "_last")
            after = ends.select(*keys, (F.col("_block") - 1).alias("_block"), "_first")
            u = (u.join(before, [*keys, "_block"], "left").join(after, [*keys, "_block"], "left")
                  .withColumn("_prev", F.coalesce("_prev", "_last")).withColumn("_next", F.coalesce("_next", "_first")))
        gp = F.datediff(F.col("_t"), F.col("_prev.d"))
        gn = F.datediff(F.col("_next.d"), F.col("_t"))
        pick = (F.when(F.col("_prev").isNull(), F.col("_next"))
                 .when(F.col("_next").isNull(), F.col("_prev"))
                 .when(gp <= gn, F.col("_prev")).otherwise(F.col("_next")))
        u = u.withColumn("_m", pick)
        u = u.withColumn("_m", F.when(F.abs(F.datediff(F.col("_t"), F.col("_m.d"))) <= tol, F.col("_m")))
        match = u.select(*keys, F.col("_t").alias("_day"), F.col("_m.d").alias(match_date_name),
                         *[F.col(f"_m.{v}").alias(v) for v in rvals])
    else:
        raise ValueError(f"unknown method {method!r}")

    out = left.withColumn("_day", day).join(match, keys + ["_day"], "left")
    return (out.withColumn(gap_name, F.datediff(F.col("_day"), F.col(match_date_name)))
               .drop("_day"))


# --------------------------------------------------------------------------
# E28
# --------------------------------------------------------------------------
def match_coverage(matched: DataFrame, keys: str | Sequence[str], probe_col: str) -> DataFrame:
    """Per key: rows, matched rows (probe not null), share matched."""
    keys = _cols(keys)
    return (matched.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col(probe_col).isNotNull()).alias("n_matched"))
            .withColumn("coverage", F.col("n_matched") / F.col("n_rows")))


# --------------------------------------------------------------------------
# A4
# --------------------------------------------------------------------------
def first_by_priority(samples: DataFrame, keys: str | Sequence[str], source_col: str,
                      value_col: str, priority: Sequence, scale: float = 1.0,
                      digits: int | None = 4, out_value: str = "value",
                      out_source: str = "source") -> DataFrame:
    """Mean per (key, source), then the first non-null mean in ``priority`` order.

    Sources outside ``priority`` are ignored; keys with no non-null mean are
    absent (inner semantics, like a city skipped for want of a reading).
    The priority list is a literal array (bounded), so no join is needed.
    """
    keys = _cols(keys)
    prio = F.array(*[F.lit(p) for p in priority])
    pos = F.array_position(prio, F.col(source_col))
    means = (samples.where(pos > 0)
             .groupBy(*keys, source_col)
             .agg(F.avg(value_col).alias("_m"))
             .where(F.col("_m").isNotNull()))
    pick = (means.groupBy(*keys)
            .agg(F.min_by(F.struct(F.col(source_col).alias("s"), F.col("_m").alias("m")),
                          F.array_position(prio, F.col(source_col))).alias("_b")))
    v = F.col("_b.m") / F.lit(float(scale)) if scale != 1.0 else F.col("_b.m")
    if digits is not None:
        v = round_half_even(v, digits)
    return pick.select(*keys, F.col("_b.s").alias(out_source), v.alias(out_value))


# --------------------------------------------------------------------------
# D2 / D3
# --------------------------------------------------------------------------
def attach_constants(rows: DataFrame, constants: DataFrame, keys: str | Sequence[str],
                     how: str = "inner") -> DataFrame:
    """Attach per-group constants; with ``inner`` a group without them is dropped."""
    return rows.join(constants, _cols(keys), how)


def fallback_union(primary: DataFrame, fallback: DataFrame, keys: str | Sequence[str],
                   tag_col: str | None = "source", primary_tag: str = "primary",
                   fallback_tag: str = "fallback") -> DataFrame:
    """Primary rows, plus fallback rows for keys with no primary row (G1 append).

    Keys in neither input are absent.  ``left_anti`` keeps the fallback side
    distributed; no key list is collected.
    """
    keys = _cols(keys)
    pk = primary.select(*keys).distinct()
    fb = fallback.join(pk, keys, "left_anti")
    if tag_col:
        primary = primary.withColumn(tag_col, F.lit(primary_tag))
        fb = fb.withColumn(tag_col, F.lit(fallback_tag))
    return primary.unionByName(fb)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` (max_by on a struct)."""
    keys = _cols(keys)
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]),
                 F.struct(*[F.col(c) for c in order_cols])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def dedupe_first(df: DataFrame, keys: str | Sequence[str], order_cols: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key under an explicit order."""
    keys = _cols(keys)
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]),
                 F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
