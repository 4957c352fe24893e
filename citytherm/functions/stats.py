"""Exact quantiles without a task that holds a whole column or group.

Each wanted rank is bracketed by a mergeable quantile sketch (one aggregate; its
rank error is a stated share of the values), then one counting pass counts what lies
below the bracket and the distinct values inside, map-side first.  Groups
of at most ``SMALL`` values, whose sizes are counted first, take an exact
aggregate instead.  Where a bracket may hold more than ``BOUND`` distinct
values, its counts are written and cut again at sketched points until it does
not.  Skewed values, far outliers, infinities and ties change nothing: brackets
follow ranks, not distances.  The answers equal pandas' linear interpolation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def long_values(df: DataFrame, cols: Sequence[str], keys=None) -> DataFrame:
    """(keys..., column_name, value DOUBLE) for the values of ``cols`` that are neither null nor NaN."""
    ks = _keys(keys)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
                        for c in cols])
    return (df.select(*ks, F.inline(entries))
              .where(F.col("value").isNotNull() & ~F.isnan("value")))


ACCURACY = 10_000       # a sketch's rank error is at most n / ACCURACY
MARGIN = 4              # a bracket reaches this many errors to both sides of a rank
SMALL = 10_000          # values of a group that an exact aggregate may hold at once
BOUND = 1_000_000       # distinct values of a bracket that one task may sort
CUTS = 15               # cut points of a round that narrows a bracket over the bound


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on ``keys`` where null equals null."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def _edges(probs: Sequence[float]) -> list[float]:
    """Probabilities of the bracket ends: low, high of each wanted one."""
    reach = MARGIN / ACCURACY
    return [e for p in probs for e in (max(p - reach, 0.0), min(p + reach, 1.0))]


def _sketch(value, probs: Sequence[float]):
    """(n, ends) of a mergeable quantile sketch; the last two ends are the extremes."""
    return F.struct(F.count(value).alias("n"), F.percentile_approx(value, [*_edges(probs), 0.0, 1.0], ACCURACY).alias("ends"))


def _narrowed(counts: DataFrame, g: list[str], probs: Sequence[float], bound: int) -> DataFrame:
    """Counts (g, n, j, value or null for all below, c) whose brackets hold at most
    ``bound`` distinct values.  The table is written, so each round reads the last
    one's rows, not the input.  Only brackets over the bound are cut again."""
    from citytherm.sources.stages import materialize
    key = [*g, "j"]
    counts = materialize(counts, "brackets")
    while True:
        wide = counts.where("value IS NOT NULL").groupBy(*key).count().where(F.col("count") > bound)
        if wide.isEmpty():
            return counts
        cuts = (join_null_safe(counts.where("value IS NOT NULL"), wide.select(*key), key).groupBy(*key)
                .agg(F.percentile_approx("value", [i / (CUTS + 1) for i in range(1, CUTS + 1)], ACCURACY).alias("cuts")))
        kept = counts.join(wide.withColumnsRenamed({k: f"_w_{k}" for k in key}),
                           [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in key], "left_anti")
        cell = sum(((F.col("value") > F.get("cuts", F.lit(i))).cast("int") for i in range(CUTS)), F.lit(0))
        celled = (join_null_safe(counts, cuts, key).withColumn("cell", F.when(F.col("value").isNull(), F.lit(-1)).otherwise(cell)).drop("cuts"))
        sizes = celled.groupBy(*key, "cell").agg(F.max("n").alias("n"), F.sum("c").alias("c"))
        run = F.sum("c").over(Window.partitionBy(*key).orderBy("cell"))  # at most CUTS + 2 rows
        ranked = sizes.withColumn("before", run - F.col("c"))
        held = F.exists(_ranks_of(probs), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("c")))
        mine = ranked.where((F.col("cell") >= 0) & held).select(*key, "cell", "before")
        first = mine.groupBy(*key).agg(F.min("cell").alias("lowest"), F.max("cell").alias("highest"))
        low = join_null_safe(celled, first, key)
        inner = low.where(F.col("cell").between(F.col("lowest"), F.col("highest"))).select(*counts.columns)
        below = (low.where(F.col("cell") < F.col("lowest")).groupBy(*key).agg(F.max("n").alias("n"), F.sum("c").alias("c"))
                 .withColumn("value", F.lit(None).cast("double")).select(*counts.columns))
        smaller = materialize(kept.unionByName(inner).unionByName(below), "brackets")
        if smaller.count() == counts.count():
            return smaller  # two ranks at a bracket's ends
        counts = smaller


def _at_ranks(counts: DataFrame, g: list[str], probs: Sequence[float]) -> DataFrame:
    """(g, q) from counts (g, n, j, value, c)."""
    run = F.sum("c").over(Window.partitionBy(*g, "j").orderBy(F.col("value").asc_nulls_first()))  # at most BOUND rows
    held = counts.withColumn("before", run - F.col("c")).where("value IS NOT NULL")
    inside = F.filter(_ranks_of(probs), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("c")))
    by_rank = held.select(*g, "n", "j", "value", F.explode(inside).alias("r"))
    found = by_rank.groupBy(*g).agg(F.max("n").alias("n"), F.map_from_entries(F.collect_set(F.struct(F.struct("j", "r"), "value"))).alias("at"))

    def value(j: int, p: float):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
        get = lambda r: F.try_element_at("at", F.struct(F.lit(j).alias("j"), r.alias("r")))
        a, b = get(low), get(high)
        exact = F.when((low == high) | (a == b), a).otherwise((high - pos) * a + (pos - low) * b)
        # the sketch's error bound makes this impossible; a wrong answer would be worse than none
        return F.when(a.isNull() | b.isNull(), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(exact)
    return found.select(*g, F.array(*[value(j, p) for j, p in enumerate(probs)]).alias("q"))


def _ranks_of(probs: Sequence[float]):
    """Distinct 0-based ranks that the quantile ``j`` of ``n`` values needs."""
    pos = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("j") + 1) * (F.col("n") - 1)
    return F.array_distinct(F.array(F.floor(pos).cast("long"), F.ceil(pos).cast("long")))


def _counted(values: DataFrame, g: list[str], probs: Sequence[float], bound: int) -> DataFrame:
    """Quantiles of (g, value) rows by sketched brackets, for groups of ``ACCURACY``
    values or more: there a bracket's margin is several ranks."""
    from citytherm.sources.stages import materialize
    # one row for each group, written once: the sketches are not computed again by the count
    ends = materialize(values.groupBy(*g).agg(_sketch(F.col("value"), probs).alias("s")).select(*g, "s.*"), "sketches")
    joined = join_null_safe(values, ends, g)
    entries = []
    for j in range(len(probs)):
        v, lo, hi = F.col("value"), F.get("ends", F.lit(2 * j)), F.get("ends", F.lit(2 * j + 1))
        entries.append(F.struct(F.lit(j).alias("j"), F.when(v >= lo, v).alias("value"), (v <= hi).alias("take")))
    counts = (joined.select(*g, "n", F.inline(F.array(*entries))).where("take")
              .groupBy(*g, "j", "value").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("c")))
    most = ends.agg(F.max("n")).first()[0] or 0
    if most * 3 * MARGIN / ACCURACY > bound:
        counts = _narrowed(counts.select(*g, "n", "j", "value", "c"), g, probs, bound)
    return _at_ranks(counts, g, probs)


def _columns(df: DataFrame, cols: Sequence[str], probs: Sequence[float], bound: int) -> DataFrame:
    """Quantiles of whole columns: the sketches' few numbers become literals of one counting pass."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    values = df.select(*[v.alias(f"v{i}") for i, v in enumerate(clean.values())])
    row = values.agg(*[_sketch(F.col(f"v{i}"), probs).alias(f"s{i}") for i in range(len(cols))]).first()
    entries, most = [], 0
    for i, c in enumerate(cols):
        n, ends = row[f"s{i}"]["n"], row[f"s{i}"]["ends"]
        if not n:
            continue
        most = max(most, n)
        for j in range(len(probs)):
            lo, hi = ends[-2:] if n < ACCURACY else ends[2 * j: 2 * j + 2]
            v = F.col(f"v{i}")
            entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("long").alias("n"), F.lit(j).alias("j"),
                                    F.when(v >= F.lit(lo), v).alias("value"), (v <= F.lit(hi)).alias("take")))
    if not entries:
        return df.sparkSession.createDataFrame([], "column_name string, q array<double>")
    g = ["column_name"]
    counts = (values.select(F.inline(F.array(*entries))).where("take")
              .groupBy(*g, "n", "j", "value").agg(F.count(F.lit(1)).alias("c")))
    if most * 3 * MARGIN / ACCURACY > bound:
        counts = _narrowed(counts.select(*g, "n", "j", "value", "c"), g, probs, bound)
    return _at_ranks(counts, g, probs)


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys=None,
              small: int = SMALL, bound: int = BOUND) -> DataFrame:
    """One row per (keys..., column_name) with ``q`` = array of quantiles.

    Runs one pass over ``df`` when called: sketches of whole columns, sizes of
    groups.  A plan that is dear to compute should be written first.
    """
    from citytherm.sources.stages import materialize
    ks = _keys(keys)
    if not ks:
        return _columns(df, cols, probs, bound)
    g = [*ks, "column_name"]
    values, small = long_values(df, cols, ks), max(small, ACCURACY)
    # one row for each group, written once: the passes below join it without counting again
    sizes = materialize(values.groupBy(*g).agg(F.count(F.lit(1)).alias("n")), "sizes")
    exact = F.percentile("value", F.array(*[F.lit(float(p)) for p in probs])).alias("q")
    if (sizes.agg(F.max("n")).first()[0] or 0) <= small:
        return values.groupBy(*g).agg(exact)  # every group's size has just been checked
    hot = sizes.where(F.col("n") > small).select(*g)
    other = hot.withColumnsRenamed({k: f"_h_{k}" for k in g})
    cold = values.join(other, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in g], "left_anti")
    return cold.groupBy(*g).agg(exact).unionByName(_counted(join_null_safe(values, hot, g), g, probs, bound))


def wide_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   names: Sequence[str]) -> DataFrame:
    """A one-row frame with ``<col>__<name>`` for each column and probability.

    Columns without any non-null value give nulls (pandas gives NaN).
    """
    q = quantiles(df, cols, probs)
    aggs = []
    for c in cols:
        for i, n in enumerate(names):
            aggs.append(F.max(F.when(F.col("column_name") == c, F.col("q")[i])).alias(f"{c}__{n}"))
    return q.agg(*aggs)  # <= len(cols) rows in, one row out


def group_median(df: DataFrame, keys, col: str, out: str) -> DataFrame:
    """Median of ``col`` per key (null keys excluded)."""
    ks = _keys(keys)
    src = df
    for k in ks:
        src = src.where(F.col(k).isNotNull())
    q = quantiles(src, [col], [0.5], ks)
    return q.select(*ks, F.col("q")[0].alias(out))


def global_median(df: DataFrame, col: str, out: str) -> DataFrame:
    """One-row median of ``col`` (null if there are no values)."""
    q = quantiles(df, [col], [0.5])
    return q.agg(F.max(F.col("q")[0]).alias(out))


def scalars(stats: DataFrame):
    """Fields of a one-row statistics frame as scalar-subquery columns.

    ``get = scalars(df.agg(...)); df.withColumn("z", col("x") - get("mean"))``
    attaches fitted numbers without a join: the subquery runs once (Spark
    reuses identical subqueries) and its value is inlined into every task.
    """
    sq = stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("s")).scalar()
    return lambda name: sq[name]
