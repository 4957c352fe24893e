"""The raw-observation -> feature-table chain, in the reference's order:
source filter -> inject defaults -> median impute -> range check -> IQR cap
-> features -> contrast target -> ordered feature selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytherm.operators import clean, features, target
from citytherm.sources.stages import materialize


@dataclass
class Prepared:
    table: DataFrame          # features + target + group (+ kept keys)
    outliers: DataFrame       # one row per capped column (E2)
    feature_names: list[str]  # ordered feature list (B13)


def null_census(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Null count per column in one pass; a one-row result."""
    if not cols:
        return {}
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def impute_missing(df: DataFrame, exclude: Sequence[str],
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Median-impute only the numeric columns that have nulls.

    A one-row null census decides which exact medians are worth computing,
    so a table without gaps pays one counting pass instead of a quantile
    aggregation per column.
    """
    cand = clean.numeric_columns(df, exclude)
    census = null_census(df, cand)
    todo = [c for c in cand if census.get(c, 0) > 0]
    return clean.median_impute(df, todo, fit_on=fit_on) if todo else df


def preprocess(raw: DataFrame, group: str = "name", ts: str = "timestamp",
               source_col: str | None = "source", keep: Sequence[str] = (),
               require_rows: bool = False,
               stage: bool | str = "input") -> Prepared:
    """Run the chain.  ``stage`` picks where the rows are written once to the
    shared folder and read back (lineage cut):

    * ``"input"`` (default): after the source filter, so the raw input and
      its joins are scanned once; the null census, fences, group means,
      group and global medians and the main path all read the stage (without
      it the final plan scans the input about eight times);
    * ``"validated"``: after the range check; ``"features"``: before the
      target; ``False``: no stage (one lazy plan).
    """
    d = raw
    if source_col is not None and source_col in d.columns:
        d = clean.source_filter(d, source_col)
        if require_rows:
            clean.require_rows(d, "real-data rows after the source filter")
    d = clean.inject_defaults(d)
    if stage == "input":
        d = materialize(d, "input")
    d = impute_missing(d, exclude=list(clean.NO_IMPUTE) + list(keep))
    d = clean.range_filter(d)
    if stage == "validated":
        d = materialize(d, "validated")
    cap = [c for c in clean.CAP_COLUMNS if c in d.columns]
    fences = materialize(clean.fit_fences(d, cap), "fences")  # one row, else counted again in every pass below
    report = clean.outlier_report(d, cap, fences)
    capped = clean.winsorize(d, cap, fences)
    d = features.engineer_features(capped, group=group, ts=ts)
    if stage is True or stage == "features":
        d = materialize(d, "features")
    # features change neither rows nor readings: the medians need not compute them
    d = target.contrast_target(d, "urban_lst", "rural_lst", group, out=features.TARGET_COLUMN, fit_on=capped)
    names = features.feature_list(d)
    table = features.select_features(d, names, group_src=group, keep=keep)
    return Prepared(table, report, names)
