"""Cleaning: source filter, range checks, column injection, median imputation,
IQR fences and winsorisation (C1-C3, B5, E2-E4, E29).

Fitted statistics (medians, fences) are one-row aggregates kept in the plan
and broadcast to the rows; exact quantiles by default (pandas interpolates
linearly, as Spark's ``percentile`` and DuckDB's ``quantile_cont`` do).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytherm.functions.expressions import round_half_even
from citytherm.functions.stats import wide_quantiles

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# --------------------------------------------------------------------------
# Sources counted as real observations (regex, "contains" semantics).
REAL_SOURCE_PATTERN = "openweather|openmeteo"
# Columns injected with a constant when absent.
INJECT_DEFAULTS = {
    "temperature": 20.0, "humidity": 60.0, "wind_speed": 2.0,
    "pressure": 1013.0, "clouds": 50, "ndvi": 0.3,
    "urban_fraction": 0.5, "lat": 0.0, "lon": 0.0,
    "urban_lst": None, "rural_lst": None,
}
# Physical validity ranges (inclusive).
VALID_RANGES = {
    "temperature": (-60, 60), "humidity": (0, 100), "wind_speed": (0, 100),
    "lat": (-90, 90), "lon": (-180, 180),
}
# Columns winsorised to the IQR fences, and the fence multiplier.
CAP_COLUMNS = ["temperature", "humidity", "wind_speed", "pressure", "clouds", "ndvi"]
IQR_K = 1.5
# Columns never imputed.
NO_IMPUTE = ("urban_lst", "rural_lst")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in set(exclude)]


# --------------------------------------------------------------------------
# C1-C3
# --------------------------------------------------------------------------
def source_filter(df: DataFrame, col: str, pattern: str = REAL_SOURCE_PATTERN) -> DataFrame:
    """Rows whose ``col`` contains a match of ``pattern``; null -> dropped."""
    return df.where(F.coalesce(F.col(col).rlike(pattern), F.lit(False)))


def require_rows(df: DataFrame, what: str = "rows") -> DataFrame:
    """Fail when empty (one ``limit(1)`` probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"no {what} left")
    return df


def range_filter(df: DataFrame, ranges: Mapping[str, tuple] = VALID_RANGES) -> DataFrame:
    """Keep rows with every listed column inside its inclusive range.

    A null value fails (``between`` on null is not true), as in the reference.
    Columns absent from the frame are skipped.
    """
    cond = F.lit(True)
    for c, (lo, hi) in ranges.items():
        if c in df.columns:
            cond = cond & F.coalesce(F.col(c).between(F.lit(lo), F.lit(hi)), F.lit(False))
    return df.where(cond)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


# --------------------------------------------------------------------------
# B5
# --------------------------------------------------------------------------
def inject_defaults(df: DataFrame, defaults: Mapping[str, object] = INJECT_DEFAULTS,
                    types: Mapping[str, str] | None = None) -> DataFrame:
    """Add every absent column as a constant; present columns are untouched."""
    types = dict(types or {})
    add = {}
    for c, v in defaults.items():
        if c in df.columns:
            continue
        t = types.get(c) or ("double" if isinstance(v, float) or v is None
                             else "int" if isinstance(v, int) else "string")
        add[c] = F.lit(v).cast(t)
    return df.withColumns(add) if add else df


# --------------------------------------------------------------------------
# E4
# --------------------------------------------------------------------------
def fit_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row table of column medians (``med_<col>``), exact."""
    w = wide_quantiles(df, cols, [0.5], ["med"])
    return w.select(*[F.col(f"{c}__med").alias(f"med_{c}") for c in cols])


def median_impute(df: DataFrame, cols: Sequence[str] | None = None,
                  exclude: Sequence[str] = NO_IMPUTE, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls of numeric columns with the column median.

    ``fit_on`` fits on another frame (e.g. the training split).  Integer
    columns become double: a median of 12.5 stays 12.5.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    if not cols:
        return df
    meds = fit_medians(fit_on if fit_on is not None else df, cols)
    out = df.crossJoin(F.broadcast(meds))  # one row
    repl = {c: F.coalesce(F.col(c).cast("double"), F.col(f"med_{c}")) for c in cols}
    return out.withColumns(repl).drop(*[f"med_{c}" for c in cols])


# --------------------------------------------------------------------------
# E2, E3, E29
# --------------------------------------------------------------------------
def fit_fences(df: DataFrame, cols: Sequence[str], k: float = IQR_K) -> DataFrame:
    """One-row table with q1/q3/lo/hi per column (``<col>__q1`` ...), one pass."""
    wide = wide_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"])
    sel = []
    for c in cols:
        q1, q3 = F.col(f"{c}__q1"), F.col(f"{c}__q3")
        sel += [q1.alias(f"{c}__q1"), q3.alias(f"{c}__q3"),
                (q1 - F.lit(k) * (q3 - q1)).alias(f"{c}__lo"),
                (q3 + F.lit(k) * (q3 - q1)).alias(f"{c}__hi")]
    return wide.select(*sel)


def outlier_report(df: DataFrame, cols: Sequence[str], fences: DataFrame | None = None,
                   k: float = IQR_K, digits: int | None = 3, pct_digits: int | None = 2,
                   only_capped: bool = False) -> DataFrame:
    """Per column q1, q3, iqr, fences, n below, n above, n capped, % of rows.

    Second pass counts against the broadcast fences; ``stack`` turns the one
    wide row into one row per column.
    """
    cols = list(cols)
    fences = fences if fences is not None else fit_fences(df, cols, k)
    counts = (df.select(*cols).crossJoin(F.broadcast(fences))
                .agg(F.count(F.lit(1)).alias("_n"),
                     *[F.count_if(F.col(c) < F.col(f"{c}__lo")).alias(f"{c}__nl") for c in cols],
                     *[F.count_if(F.col(c) > F.col(f"{c}__hi")).alias(f"{c}__nh") for c in cols]))
    wide = fences.crossJoin(counts)
    entries = []
    for c in cols:
        q1, q3 = F.col(f"{c}__q1"), F.col(f"{c}__q3")
        nl, nh = F.col(f"{c}__nl"), F.col(f"{c}__nh")
        ncap = nl + nh
        pct = F.lit(100.0) * ncap / F.greatest(F.col("_n"), F.lit(1))
        vals = [q1, q3, q3 - q1, F.col(f"{c}__lo"), F.col(f"{c}__hi")]
        if digits is not None:
            vals = [round_half_even(v, digits) for v in vals]
        if pct_digits is not None:
            pct = round_half_even(pct, pct_digits)
        entries.append(F.struct(F.lit(c).alias("column_name"),
                                vals[0].alias("q1"), vals[1].alias("q3"), vals[2].alias("iqr"),
                                vals[3].alias("lower_fence"), vals[4].alias("upper_fence"),
                                nl.alias("n_low"), nh.alias("n_high"), ncap.alias("n_capped"),
                                pct.alias("pct")))
    out = wide.select(F.inline(F.array(*entries)))
    return out.where(F.col("n_capped") > 0) if only_capped else out


def winsorize(df: DataFrame, cols: Sequence[str], fences: DataFrame | None = None,
              k: float = IQR_K) -> DataFrame:
    """Clip each column to its fences; values inside are untouched,
    nulls stay null.  Integer columns keep their type only if the fences
    are integral -- otherwise they become double, as pandas does."""
    cols = list(cols)
    fences = fences if fences is not None else fit_fences(df, cols, k)
    out = df.crossJoin(F.broadcast(fences))
    repl = {}
    for c in cols:
        x = F.col(c).cast("double")
        lo, hi = F.col(f"{c}__lo"), F.col(f"{c}__hi")
        repl[c] = F.when(x < lo, lo).when(x > hi, hi).otherwise(x)
    drop = [f"{c}__{s}" for c in cols for s in ("q1", "q3", "lo", "hi")]
    return out.withColumns(repl).drop(*drop)
