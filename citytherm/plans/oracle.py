"""DuckDB SQL for each registered query, written independently of the Spark
plans (joins and row_number where Spark uses windows or min_by, and so on).

Rounding mirrors ``round_half_even``: scale, ``round_even``, unscale.
"""

from __future__ import annotations

from citytherm.plans.common import CHECK_DIGITS, MATCH_TOLERANCE_DAYS, REFERENCE_TYPE

from citytherm.plans.registry import ORACLE


def R(expr: str, d: int = CHECK_DIGITS) -> str:
    return f"(round_even(({expr}) * 1e{d}, 0) / 1e{d})"


def sql(name: str):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


# --------------------------------------------------------------------------
# Slice
# --------------------------------------------------------------------------
COMPOSITE = f"""
  cr AS (
    SELECT user_id, day, {R('urban', 3)} AS urban, {R('rural', 3)} AS rural
    FROM (
      SELECT user_id, CAST(ts AS DATE) AS day,
             arg_max(CASE WHEN event_type = '{REFERENCE_TYPE}' THEN value END,
                     CASE WHEN event_type = '{REFERENCE_TYPE}' THEN {{'t': ts, 'i': event_id}} END) AS urban,
             median(CASE WHEN event_type <> '{REFERENCE_TYPE}' THEN value END) AS rural
      FROM events
      WHERE ts IS NOT NULL AND value IS NOT NULL
      GROUP BY user_id, CAST(ts AS DATE)) g
    WHERE urban IS NOT NULL AND rural IS NOT NULL)"""

MATCHED = COMPOSITE + f""",
  cl AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day FROM events),
  cand AS (
    SELECT cl.event_id, cr.day AS match_date, cr.urban, cr.rural,
           row_number() OVER (PARTITION BY cl.event_id
                              ORDER BY abs(date_diff('day', cr.day, cl.day)), cr.day) AS rn
    FROM cl JOIN cr ON cl.user_id = cr.user_id
     AND abs(date_diff('day', cr.day, cl.day)) <= {MATCH_TOLERANCE_DAYS}),
  nm AS (
    SELECT cl.event_id, cl.user_id, cl.ts, c.match_date, c.urban, c.rural,
           CAST(date_diff('day', c.match_date, cl.day) AS INTEGER) AS gap_days
    FROM cl LEFT JOIN cand c ON c.event_id = cl.event_id AND c.rn = 1)"""

CONTRAST = MATCHED + f""",
  pr AS (SELECT *, CASE WHEN urban IS NOT NULL AND rural IS NOT NULL
                        THEN greatest(urban - rural, 0.0) END AS pair FROM nm),
  gm AS (SELECT user_id, median(pair) AS gmed FROM pr WHERE user_id IS NOT NULL GROUP BY user_id),
  am AS (SELECT median(pair) AS glob FROM pr),
  ct AS (
    SELECT pr.event_id, pr.user_id,
           {R("CASE WHEN coalesce(pr.pair, gm.gmed, am.glob) IS NOT NULL THEN greatest(coalesce(pr.pair, gm.gmed, am.glob), 0.0) END", 3)} AS contrast
    FROM pr LEFT JOIN gm ON pr.user_id = gm.user_id CROSS JOIN am)"""


@sql("composite_reduce")
def _():
    return f"WITH {COMPOSITE} SELECT user_id, day, urban, rural FROM cr"


@sql("nearest_match")
def _():
    return f"WITH {MATCHED} SELECT * FROM nm"


@sql("nearest_match_window")
def _():
    return f"WITH {MATCHED} SELECT * FROM nm"


@sql("nearest_match_offsets")
def _():
    return f"WITH {MATCHED} SELECT * FROM nm"


@sql("match_coverage")
def _():
    return f"""WITH {MATCHED}
    SELECT user_id, count(*) AS n_rows, count(urban) AS n_matched,
           {R('count(urban) / count(*)')} AS coverage
    FROM nm GROUP BY user_id"""


@sql("contrast_target")
def _():
    return f"WITH {CONTRAST} SELECT event_id, user_id, contrast FROM ct"


@sql("group_ranking")
def _():
    return f"""WITH {CONTRAST}
    SELECT user_id, {R('avg(milli) / 1000.0')} AS mean, {R('stddev_samp(milli) / 1000.0')} AS std,
           min(milli) / 1000.0 AS min, max(milli) / 1000.0 AS max, count(milli) AS n
    FROM (SELECT user_id, round_even(contrast * 1000.0, 0) AS milli FROM ct) GROUP BY user_id"""
