"""E5: urban-minus-rural contrast target with group and global fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citytherm.functions.expressions import round_half_even
from citytherm.functions.stats import global_median, group_median


def contrast_target(df: DataFrame, urban: str, rural: str, group: str | None,
                    out: str = "uhi_intensity", digits: int | None = 3, fit_on: DataFrame | None = None) -> DataFrame:
    """``max(0, urban - rural)`` where both are present; else the group median of
    those values; else their global median; then clip at 0 and round.

    Rows with a null group key take the global median (a null key forms no
    group).  If no row has a pair, the target stays null.

    ``fit_on`` fits the medians on another frame.  That frame (else ``df``) is read
    several times: write a dear plan first.

    Plan: the group medians are one aggregate (partial, map-side) joined back
    on the group key -- not a window, which would put a whole group in one
    task; the global median is a one-row aggregate broadcast to every row.
    """
    pair = F.when(F.col(urban).isNotNull() & F.col(rural).isNotNull(),
                  F.greatest(F.col(urban) - F.col(rural), F.lit(0.0)))
    d = df.withColumn("_pair", pair)
    src = fit_on.withColumn("_pair", pair) if fit_on is not None else d
    glob = global_median(src, "_pair", "_glob")  # exactly one row
    if group is not None:
        gmed = group_median(src, group, "_pair", "_gmed")
        d = d.join(gmed, group, "left")
        filled = F.coalesce(F.col("_pair"), F.col("_gmed"), F.col("_glob"))
    else:
        filled = F.coalesce(F.col("_pair"), F.col("_glob"))
    d = d.crossJoin(F.broadcast(glob))
    t = F.when(filled.isNotNull(), F.greatest(filled, F.lit(0.0)))
    if digits is not None:
        t = round_half_even(t, digits)
    return d.withColumn(out, t).drop("_pair", "_gmed", "_glob")
