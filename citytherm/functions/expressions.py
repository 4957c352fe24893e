"""Column-expression builders (scalar functions, B-series).

Everything here returns a ``Column`` built from built-in Spark functions, so
it stays inside whole-stage codegen.  Columns may be given as names or
``Column`` objects.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# --------------------------------------------------------------------------
# Month number -> short name.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# Heat-index polynomial used at training time (c0 + c1*t + c2*h/100 + c3*t*h/100).
HEAT_INDEX_TRAIN = (-8.78469475556, 1.61139411, 2.33854883889, -0.14611605)
# The same polynomial with the short coefficients used when scoring scenarios.
HEAT_INDEX_SCORE = (-8.78, 1.61, 2.34, -0.15)
# Severity cuts and labels: reference table (< 1, 1-2, 2-3, 3-5, > 5 degrees).
SEVERITY_TABLE_CUTS = (1.0, 2.0, 3.0, 5.0)
SEVERITY_TABLE_LABELS = ("Negligible", "Low", "Moderate", "High", "Extreme")
# Severity of a scored row (< 1, < 2, < 4, else).
SEVERITY_SCORE_CUTS = (1.0, 2.0, 4.0)
SEVERITY_SCORE_LABELS = ("Low", "Moderate", "High", "Extreme")
# Vegetation class edges (right-closed at training time).
VEG_CLASS_CUTS = (0.2, 0.5)
# Day flag bounds (inclusive) and the fill values for a missing timestamp.
DAY_START_HOUR, DAY_END_HOUR = 6, 18
DEFAULT_HOUR, DEFAULT_MONTH = 12, 6


# --------------------------------------------------------------------------
# Rounding
# --------------------------------------------------------------------------
def round_half_even(c: ColumnOrName, digits: int) -> Column:
    """Round like NumPy/pandas: scale in binary, round half to even, unscale.

    ``rint`` rounds the scaled double to the nearest integer, ties to even,
    without a decimal round trip (``bround`` would build a BigDecimal per
    row), and stays inside generated code.
    """
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


# --------------------------------------------------------------------------
# Rescales, defaults, clips
# --------------------------------------------------------------------------
def default_if_missing(c: ColumnOrName, default, zero_is_missing: bool = False) -> Column:
    """Null (and optionally 0) -> default."""
    x = col(c)
    if zero_is_missing:
        x = F.when(x != 0, x)
    return F.coalesce(x, F.lit(default))


def clip(c: ColumnOrName, lower: float | None = None, upper: float | None = None) -> Column:
    """Null-preserving clip (B4).  ``greatest``/``least`` skip nulls, so guard."""
    x = col(c)
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(x.isNotNull(), out)


# --------------------------------------------------------------------------
# Calendar, flags, bins
# --------------------------------------------------------------------------
def parse_timestamp(c: ColumnOrName) -> Column:
    """Text or timestamp -> TIMESTAMP_NTZ; unparsable text -> null."""
    return F.try_to_timestamp(col(c).cast("string")).cast("timestamp_ntz")


def hour_or_default(ts: ColumnOrName | None) -> Column:
    if ts is None:
        return F.lit(DEFAULT_HOUR)
    return F.coalesce(F.hour(col(ts)), F.lit(DEFAULT_HOUR))


def month_or_default(ts: ColumnOrName | None) -> Column:
    if ts is None:
        return F.lit(DEFAULT_MONTH)
    return F.coalesce(F.month(col(ts)), F.lit(DEFAULT_MONTH))


def is_daytime(hour: ColumnOrName) -> Column:
    return col(hour).between(DAY_START_HOUR, DAY_END_HOUR).cast("int")


def is_night(hour: ColumnOrName) -> Column:
    h = col(hour)
    return ((h < DAY_START_HOUR) | (h > DAY_END_HOUR)).cast("int")


def right_closed_bin(c: ColumnOrName, cuts: Sequence[float] = VEG_CLASS_CUTS,
                     lower: float = -1.0, upper: float = 1.0) -> Column:
    """Clip to [lower, upper], then bin right-closed: x <= cuts[0] -> 0 ...."""
    x = clip(c, lower, upper)
    expr = None
    for i, cut in enumerate(cuts):
        expr = (F.when(x <= F.lit(cut), F.lit(i)) if expr is None
                else expr.when(x <= F.lit(cut), F.lit(i)))
    return F.when(x.isNotNull(), expr.otherwise(F.lit(len(cuts))))


def left_closed_bin(c: ColumnOrName, cuts: Sequence[float] = VEG_CLASS_CUTS,
                    lower: float = -1.0, upper: float = 1.0) -> Column:
    """Scoring-time variant: x < cuts[0] -> 0, x >= cuts[-1] -> last."""
    x = clip(c, lower, upper)
    expr = None
    for i, cut in enumerate(cuts):
        expr = (F.when(x < F.lit(cut), F.lit(i)) if expr is None
                else expr.when(x < F.lit(cut), F.lit(i)))
    return F.when(x.isNotNull(), expr.otherwise(F.lit(len(cuts))))


# --------------------------------------------------------------------------
# Interactions, encodings, heat index
# --------------------------------------------------------------------------
def temp_humidity_interaction(t: ColumnOrName, h: ColumnOrName) -> Column:
    return col(t) * col(h) / F.lit(100.0)


def wind_cooling_effect(w: ColumnOrName, t: ColumnOrName, base: float = 20.0) -> Column:
    return col(w) * clip(col(t) - F.lit(base), lower=0.0)


def heat_retention(u: ColumnOrName, t: ColumnOrName, w: ColumnOrName) -> Column:
    return col(u) * col(t) / (col(w) + F.lit(1.0))


def cyclical(c: ColumnOrName, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    angle = F.lit(2.0 * math.pi) * col(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def geo_encoding(lat: ColumnOrName, lon: ColumnOrName) -> dict[str, Column]:
    """abs(lat) twice, sin/cos(radians(lon))."""
    rad = F.radians(col(lon))
    return {
        "lat_abs": F.abs(col(lat)),
        "lon_sin": F.sin(rad),
        "lon_cos": F.cos(rad),
        "distance_from_equator": F.abs(col(lat)),
    }


def heat_index(t: ColumnOrName, h: ColumnOrName, coeffs=HEAT_INDEX_TRAIN) -> Column:
    """Four-term polynomial in temperature and humidity/100."""
    c0, c1, c2, c3 = coeffs
    tt, hh = col(t), col(h) / F.lit(100.0)
    return F.lit(c0) + F.lit(c1) * tt + F.lit(c2) * hh + F.lit(c3) * tt * hh


# --------------------------------------------------------------------------
# Names, bands, factors, normalisation
# --------------------------------------------------------------------------
def month_name(month: ColumnOrName) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.element_at(names, col(month).cast("int"))


def band(c: ColumnOrName, cuts: Sequence[float], labels: Sequence[str],
         right_open: bool = True) -> Column:
    """Chained thresholds: x < cuts[0] -> labels[0] ... else labels[-1].

    ``right_open=False`` uses <= (a value on a cut goes to the lower band).
    """
    assert len(labels) == len(cuts) + 1
    x = col(c)
    expr = None
    for cut, lab in zip(cuts, labels):
        cond = (x < F.lit(cut)) if right_open else (x <= F.lit(cut))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return F.when(x.isNotNull(), expr.otherwise(F.lit(labels[-1])))


def severity_score(c: ColumnOrName) -> Column:
    return band(c, SEVERITY_SCORE_CUTS, SEVERITY_SCORE_LABELS)


def severity_table(c: ColumnOrName) -> Column:
    return band(c, SEVERITY_TABLE_CUTS, SEVERITY_TABLE_LABELS)


def driver_factors(temp, hum, wind, ndvi, uf, clouds) -> dict[str, Column]:
    """Six 0..1 driver factors of a scenario."""
    return {
        "f_urban_fraction": col(uf),
        "f_temperature": F.least(F.lit(1.0), F.greatest(F.lit(0.0), (col(temp) + 10.0) / 60.0)),
        "f_low_vegetation": F.lit(1.0) - col(ndvi),
        "f_high_humidity": col(hum) / 100.0,
        "f_low_wind": F.lit(1.0) - F.least(F.lit(1.0), col(wind) / 15.0),
        "f_no_clouds": F.lit(1.0) - col(clouds) / 100.0,
    }


def minmax_normalise(c: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName,
                     invert: bool = False) -> Column:
    """(x-min)/(max-min+1e-9), constant set -> 0.5, optionally 1-that."""
    x, mn, mx = col(c), col(lo), col(hi)
    v = F.when(mx > mn, (x - mn) / (mx - mn + F.lit(1e-9))).otherwise(F.lit(0.5))
    return F.lit(1.0) - v if invert else v


# --------------------------------------------------------------------------
# Moments: bias-corrected skewness / excess kurtosis (pandas / DuckDB)
# --------------------------------------------------------------------------
def sample_skewness(c: ColumnOrName) -> Column:
    """G1 = g1 * sqrt(n(n-1)) / (n-2); Spark's ``skewness`` is g1."""
    n = F.count(col(c)).cast("double")
    return F.when(n > 2, F.skewness(col(c)) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_excess_kurtosis(c: ColumnOrName) -> Column:
    """G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6); Spark's ``kurtosis`` is g2."""
    n = F.count(col(c)).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(col(c)) + 6))
