"""Counts, means and co-moments of all pairs of columns.

Each task adds up a p x p accumulator for each key with matrix products over Arrow
batches: over the rows where both columns of a pair are present, their number and
the sums, squares and products of the values less a shift.  The shift is the columns' mean, taken
in a pass of plain averages first, so numbers around 1e9 keep their digits, and the
same for all tasks, so accumulators merge by adding them up: one grouped sum.  NaN counts as null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HELD_KEYS = 64  # accumulators that a task holds at once; more keys flush the oldest


class _Pairs:
    """Sums over the rows where both columns are present, of values less ``shift``."""

    def __init__(self, shift: np.ndarray):
        self.shift = shift
        self.n, self.s, self.q, self.c = (np.zeros((len(shift), len(shift))) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        present = ~np.isnan(x)
        if present.all():  # the sums of a column are the same beside every other one
            y = x - self.shift
            self.n += len(y)
            self.s += y.sum(0)[:, None]
            self.q += (y * y).sum(0)[:, None]
            self.c += y.T @ y
            return
        y = np.where(present, x - self.shift, 0.0)
        m = present.astype(np.float64)
        self.n += m.T @ m
        self.s += y.T @ m          # s[i, j]: sum of column i where j is present too
        self.q += (y * y).T @ m
        self.c += y.T @ y

    def rows(self) -> Iterator[tuple]:
        for i in range(len(self.n)):
            j = slice(i, None)
            yield (i, self.n[i, j], self.s[i, j], self.s[j, i], self.q[i, j], self.q[j, i], self.c[i, j])


_FIELDS = ["n", "s_i", "s_j", "q_i", "q_j", "c"]


def _accumulate(keys: list[str], shift: np.ndarray):
    def emit(held: dict) -> Iterator[tuple]:
        for key, pairs in held.items():
            for row in pairs.rows():
                yield (*key, *row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Pairs] = {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [pa.array(c, t) for c, t in zip(columns, types[: len(keys)])]
            arrays += [pa.array(columns[len(keys)], pa.int32())] + [pa.array([x.tolist() for x in c], pa.list_(pa.float64())) for c in columns[len(keys) + 1:]]
            return pa.RecordBatch.from_arrays(arrays, [*keys, "i", *_FIELDS])
        types: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.column(k).type for k in range(len(keys))]
            values = batch.column(len(keys))
            x = values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if keys:
                code = np.zeros(batch.num_rows, np.int64)  # numbers of the batch's different keys
                for k in range(len(keys)):
                    own = batch.column(k).dictionary_encode()
                    place = own.indices.fill_null(len(own.dictionary)).to_numpy()
                    _, first, code = np.unique(code * (len(own.dictionary) + 1) + place, return_index=True, return_inverse=True)
                names = batch.select(keys).take(pa.array(first)).to_pylist()
                ends = np.cumsum(np.bincount(code))[:-1]
                parts = [(tuple(row[k] for k in keys), part) for row, part in zip(names, np.split(x[np.argsort(code, kind="stable")], ends))]
            else:
                parts = [((), x)]
            for key, part in parts:
                if key not in held:
                    if len(held) >= HELD_KEYS:
                        oldest = next(iter(held))
                        yield out(list(emit({oldest: held.pop(oldest)})))
                    held[key] = _Pairs(shift)
                held[key].add(part)
        if held:
            yield out(list(emit(held)))
    return run


def co_moments_of(values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, i, j, n, mean_i, mean_j, c_ii, c_jj, c_ij) for i <= j, where column
    ``x`` of ``values`` is an array of doubles of one length."""
    keys = list(keys)
    kinds = "".join(f"`{k}` {values.schema[k].dataType.simpleString()}, " for k in keys)
    filled = values.select(*keys, F.transform("x", lambda v: F.coalesce(v, F.lit(float("nan")))).alias("x"))
    some = filled.where("x IS NOT NULL").select(F.size("x")).first()  # arrays are of one length
    size = some[0] if some else 0
    own = [F.get("x", F.lit(i)) for i in range(size)]
    means = filled.agg(*[F.avg(F.when(~F.isnan(v), v)) for v in own]).first() if size else []
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])  # p numbers
    parts = filled.mapInArrow(_accumulate(keys, shift), kinds + "i int, " + ", ".join(f"{f} array<double>" for f in _FIELDS))
    g = [*keys, "i", "j"]
    sums = (parts.select(*keys, "i", F.posexplode(F.arrays_zip(*_FIELDS)).alias("j", "z")).select(*keys, "i", (F.col("j") + F.col("i")).alias("j"), "z.*")
            .groupBy(*g).agg(*[F.sum(f).alias(f) for f in _FIELDS]))
    n, at = F.col("n"), F.array(*[F.lit(float(x)) for x in shift]).cast("array<double>")
    centre = lambda a, b, both: F.when(n > 0, F.col(both) - F.col(a) * F.col(b) / n)
    return sums.select(*g, n.cast("long").alias("n"),
                       F.when(n > 0, F.get(at, "i") + F.col("s_i") / n).alias("mean_i"), F.when(n > 0, F.get(at, "j") + F.col("s_j") / n).alias("mean_j"),
                       F.greatest(centre("s_i", "s_i", "q_i"), F.lit(0.0)).alias("c_ii"), F.greatest(centre("s_j", "s_j", "q_j"), F.lit(0.0)).alias("c_jj"),
                       centre("s_i", "s_j", "c").alias("c_ij"))


def co_moments(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """As ``co_moments_of``, over named columns."""
    return co_moments_of(df.select(*keys, F.array(*[F.col(c).cast("double") for c in cols]).alias("x")), keys)
