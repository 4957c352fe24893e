"""Near-duplicate documents: SetSketch registers, bands, joint estimate, exact check.

A document's set holds its distinct 5-word shingles (64-bit hashes).  Documents
with the same set form one class, found by a grouped aggregate over a 128-bit
key, so thousands of exact copies cost one sketch.

*Sketch.*  Every shingle is a Poisson process of arrivals, each marked with one
of ``registers`` registers; a register keeps the smallest arrival it sees, stored
as a truncated exponent ``1 - log_b(arrival)``.  Larger exponents win, so
sketches merge by maximum, and two registers agree with a probability of at
least the Jaccard similarity.

*Search.*  ``bands`` groups of ``rows`` registers are hashed to buckets.  At
similarity 0.75 a pair misses all 40 bands of 5 with probability 2e-5.  Buckets
do not emit all their pairs.  In a pivot round each member is paired with one
other (of its buckets' first members the one that it shares most bands with) and
verified links give components, so a large group of near copies costs one pair for
each member.  Then the members of buckets that still hold several components are
compared by their registers in blocks of bounded size (a bucket of any size is cut
into blocks) with their texts at hand, and pairs of different components whose
estimate may reach the threshold are checked there.  What leaves a block joins
members that nothing there joined before, at most one link for each.

*Check.*  A pair's registers give the maximum-likelihood similarity from the
counts of larger, smaller and equal registers and the two set sizes; pairs far
under the threshold (4.5 standard errors) stop there.  All others are decided
on the full shingle sets.

Defined cases: null, empty and blank texts have 0 shingles and no links; rows
with a null ``doc_id`` are not linked (``component_id`` null, ``kept`` true); rows
that share a ``doc_id`` are one document; repeated rows appear as often as they
came; other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import _U, _keys, discard, mix, shingles, slices, spread, stage, table, tidy, utf8
from citytherm.llm.components import components


@dataclass(frozen=True)
class Settings:
    percent: int = 75  # link when 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5
    base: float = 1.001
    pivot_rounds: int = 1
    block: int = 512  # expected members of a bucket that are compared at a time

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def floor(self) -> float:
        """Estimates under this are 4.5 standard errors under the threshold."""
        j = self.percent / 100
        return j - 4.5 * (j * (1 - j) / self.registers) ** 0.5


_STEP = 0x9E3779B97F4A7C15


def sketch(sets: list[np.ndarray], s: Settings) -> np.ndarray:
    """uint16 registers, one row per set; 0 where the set is empty."""
    m = s.registers
    size = np.array([len(x) for x in sets])
    least = np.full((len(sets), m), np.inf)
    todo = np.flatnonzero(size)
    reach = 8.0 + np.log(m)
    while len(todo):
        # arrivals after reach/size come too late unless a register stays empty
        limit = reach / size[todo]
        element = np.concatenate([sets[i] for i in todo])
        owner = np.repeat(np.arange(len(todo)), size[todo])
        time = np.zeros(len(element))
        least[todo] = np.inf
        count = 0
        while len(element):
            count += 1
            draw = mix(element + _U(count * _STEP % (1 << 64)))
            time = time - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
            alive = time < limit[owner]
            element, owner, time, draw = element[alive], owner[alive], time[alive], draw[alive]
            register = ((mix(draw) >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
            np.minimum.at(least, (todo[owner], register), time)
        todo = todo[np.isinf(least[todo]).any(axis=1)]
        reach *= 2
    with np.errstate(divide="ignore"):
        exponent = np.floor(1.0 - (np.log(least) - np.log(20.0)) / np.log(s.base))
    return np.where(size[:, None] > 0, np.clip(exponent, 0, 65535), 0).astype(np.uint16)


def band_keys(registers: np.ndarray, s: Settings) -> np.ndarray:
    values = registers.reshape(len(registers), s.bands, s.rows).astype(np.uint64)
    return mix((values * _keys(s.rows, 5)).sum(axis=2) + _keys(s.bands, 9) * _U(3)).astype(np.int64)


def estimate(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray, s: Settings) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs with known sizes."""
    larger, smaller = (u > v).sum(axis=1), (u < v).sum(axis=1)
    equal = u.shape[1] - larger - smaller
    a, b = nu / (nu + nv), nv / (nu + nv)
    grid = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(a / b, b / a)[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (s.base - 1) / s.base) / np.log(s.base)
    up, down = p(a[:, None] - b[:, None] * grid), p(b[:, None] - a[:, None] * grid)
    tiny = 1e-12
    fit = (larger[:, None] * np.log(up + tiny) + smaller[:, None] * np.log(down + tiny)
           + equal[:, None] * np.log(np.clip(1 - up - down, tiny, 1)))
    return grid[np.arange(len(grid)), fit.argmax(axis=1)]


def _sketch_rows(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                sets = shingles(data, offsets)
                key = np.array([np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64) for x in sets])
                flat = sketch(sets, s)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(x) for x in sets], pa.int64()), pa.array(key[:, 0]), pa.array(key[:, 1]),
                     pa.array([r.tobytes() for r in flat], pa.binary())],
                    ["doc_id", "hash", "n_shingles", "k1", "k2", "registers"])
    return run


def _bands(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                data, _ = utf8(part.column(1))
                keys = band_keys(np.frombuffer(data.tobytes(), np.uint16).reshape(part.num_rows, s.registers), s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.tile(np.arange(s.bands, dtype=np.int32), part.num_rows)),
                     pa.array(np.repeat(part.column(0).to_numpy(), s.bands))], ["key", "band", "node"])
    return run


def _verify(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint64))  # pairs arrive sorted by v
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                col = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                reg = [np.frombuffer(utf8(col[c])[0].tobytes(), np.uint16).reshape(part.num_rows, s.registers) for c in ("ru", "rv")]
                nu, nv = col["nu"].to_numpy(), col["nv"].to_numpy()
                j = estimate(*reg, nu, nv, s)
                u, v = col["u"].to_numpy(), col["v"].to_numpy()
                ok = np.zeros(part.num_rows, dtype=bool)
                for i in np.flatnonzero((j >= s.floor) & (100 * np.minimum(nu, nv) >= s.percent * np.maximum(nu, nv))):
                    if kept[0] != v[i]:
                        kept = (v[i], shingles(*utf8(col["tv"].slice(i, 1)))[0])
                    mine = shingles(*utf8(col["tu"].slice(i, 1)))[0]
                    at_v = np.minimum(np.searchsorted(kept[1], mine), len(kept[1]) - 1)
                    both = int((kept[1][at_v] == mine).sum())
                    ok[i] = 100 * both >= s.percent * (len(mine) + len(kept[1]) - both)
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], ["u", "v"])
    return run


def _links(pairs: DataFrame, sides: DataFrame, s: Settings) -> DataFrame:
    """The pairs (u, v) that are links, decided on both full texts."""
    named = lambda c: sides.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n{c}"),
                                   F.col("registers").alias(f"r{c}"), F.col("text").alias(f"t{c}"))
    return (pairs.join(named("u"), "u").join(named("v"), "v").mapInArrow(tidy(_verify(s)), "u long, v long"))


def _pivot_pairs(rest: DataFrame, turn: int) -> DataFrame:
    """Pair each member with one member of another component of its buckets: of
    the buckets' first members (by a hash that changes each turn) the one that it
    shares most buckets with.  At most one pair per member and turn."""
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "comp")
    first = rest.groupBy("key").agg(F.min(order).alias("p"))
    return (rest.join(first, "key").where("comp <> p.comp")
            .groupBy("node", F.col("p.node").alias("pivot")).agg(F.count("*").alias("n"))
            .groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot"))
            .select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")).distinct())


def _compare(s: Settings):
    """Rows (key, i, j, b, band, node, comp, n_shingles, registers, text) sorted by
    (key, i, j): links between members of different components, one of block i and
    one of block j.  A pair that shares several buckets is judged in that of its
    first common band; a pair that earlier links of the block connect is not."""
    def links(group: list[tuple]) -> Iterator[tuple[int, int]]:
        i, j, band = group[0][1], group[0][2], group[0][4]
        root = {g[6]: g[6] for g in group}
        if len(root) < 2:
            return

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        sets: dict[int, np.ndarray] = {}

        def set_of(g):
            if g[5] not in sets:
                sets[g[5]] = shingles(*utf8(pa.array([g[9]], pa.string())))[0]
            return sets[g[5]]
        left, right = [g for g in group if g[3] == i], [g for g in group if g[3] == j]
        n2 = np.array([g[7] for g in right])
        reg2 = np.frombuffer(b"".join(g[8] for g in right), np.uint16).reshape(len(right), s.registers)
        comp2 = np.array([g[6] for g in right])
        for x, mine in enumerate(left):
            near = (100 * np.minimum(mine[7], n2) >= s.percent * np.maximum(mine[7], n2)) & (comp2 != mine[6])
            if i == j:
                near[: x + 1] = False
            near = np.flatnonzero(near)
            same = reg2[near] == np.frombuffer(mine[8], np.uint16)
            # registers agree about as often as the sets do, and never much less
            likely = same.sum(axis=1) >= (s.floor - 0.02) * s.registers
            near, same = near[likely], same[likely]
            near = near[same.reshape(len(near), s.bands, s.rows).all(axis=2).argmax(axis=1) == band]
            if not len(near):
                continue
            own = np.broadcast_to(np.frombuffer(mine[8], np.uint16), (len(near), s.registers))
            fit = estimate(own, reg2[near], np.full(len(near), mine[7]), n2[near], s) >= s.floor
            for y in near[fit]:
                other = right[y]
                if top(mine[6]) != top(other[6]):
                    a, b = set_of(mine), set_of(other)
                    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                    if 100 * both >= s.percent * (len(a) + len(b) - both):
                        root[top(mine[6])] = top(other[6])
                        yield max(mine[5], other[5]), min(mine[5], other[5])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(group):
            found = list(links(group)) if group else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:3] != group[0][:3]:
                    yield from flush(group)
                    group = []
                group.append(row)
        yield from flush(group)
    return run


def _block_links(rest: DataFrame, sides: DataFrame, s: Settings) -> DataFrame:
    """Links between different components of a bucket, block by block."""
    parts = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = rest.groupBy("key").agg(F.ceil(F.count("*") / F.lit(float(s.block))).cast("int").alias("blocks"))
    rows = (rest.join(size, "key").join(sides, "node").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = rows.select("key", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "b", "band", "node", "comp",
                        "n_shingles", "registers", "text")
    return (dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
            .mapInArrow(tidy(_compare(s)), "u long, v long"))


def _labelled(shared: DataFrame, joined: DataFrame | None) -> DataFrame:
    if joined is None:
        return shared.withColumn("comp", F.col("node"))
    known = joined.withColumnRenamed("component", "comp")
    return shared.join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def classes(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``documents``."""
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    rows = stage(texts.mapInArrow(tidy(_sketch_rows(s)), "doc_id long, hash long, n_shingles long, k1 long, k2 long, registers binary"), "sketch")
    filled = rows.where("doc_id is not null and n_shingles > 0")
    # equal sets are one node, named by the smallest id
    same = stage(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "nodes")
    # a node has one row for each of its sets: an id may come with several texts
    heads = (filled.join(same, ["k1", "k2"]).where("doc_id = node").groupBy("node", "k1", "k2")
             .agg(F.min(F.struct("hash", "n_shingles", "registers")).alias("h")).select("node", "k1", "k2", "h.*"))

    bands = heads.select("node", "registers").mapInArrow(tidy(_bands(s)), "key long, band int, node long")
    crowded = bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key")
    shared = stage(bands.join(crowded, "key").select("key", "band", "node"), "buckets")
    wanted = shared.select("node").distinct()
    # each set with the text it comes from; rows that repeat one text count once
    own = texts.withColumnRenamed("doc_id", "node").join(wanted, "node", "left_semi")
    sides = stage(spread(heads.join(own, ["node", "hash"]).groupBy("node", "k1", "k2", "n_shingles", "registers").agg(F.min("text").alias("text"))
                         .drop("k1", "k2")), "candidates")

    # a document under several texts joins their nodes
    member = filled.select("doc_id", "k1", "k2").join(same, ["k1", "k2"])
    several = member.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("u")).where("u <> v")
    edges = member.join(several.select("doc_id", "v"), "doc_id").select(F.col("node").alias("u"), "v").where("u <> v")
    edges = stage(edges, "links")
    joined = None
    for turn in range(s.pivot_rounds):
        pairs = stage(_pivot_pairs(_open(_labelled(shared, joined)), turn), "pairs")
        edges = edges.unionAll(stage(_links(pairs, sides, s), "links"))
        joined = components(edges)
    rest = stage(_open(_labelled(shared, joined)), "open")
    joined = components(edges.unionAll(stage(_block_links(rest, sides, s), "links")))
    for done in (sides, shared, rest):
        discard(done)
    # empty sets share a key, but are linked with nothing
    nodes = rows.select("doc_id", "n_shingles", "k1", "k2").join(same.select("k1", "k2", "node"), ["k1", "k2"], "left")
    found = nodes.join(joined.select("node", "component"), "node", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))


def _open(labelled: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component."""
    keys = labelled.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
    return labelled.join(keys, "key").select("key", "band", "node", "comp")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its component of near-duplicates."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
