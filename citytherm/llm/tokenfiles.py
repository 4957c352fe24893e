"""Token files: texts as ids in document order, compressed by a grammar (Re-Pair).

Documents are dealt by ranges of their id, ordered in each range and encoded in
that order; ids of consecutive documents fill a shard.  In a shard the pairs of
neighbouring ids that occur most are replaced by nonterminals, round after round,
until no pair occurs ``least`` times or a round gains next to nothing; pairs of one round share no symbol that
is the left of one and the right of another, so their places cannot overlap.
Pairs of one symbol with itself take turns from the left of each run.

A token file is a Parquet table that Spark's committer writes (a lost task leaves
nothing behind), one row for a shard: its place, the ids and token counts of its
documents, and a payload of

    magic "RPG1", then rules, symbols, terminals, width (4 unsigned 32-bit),
    left and right symbol of each rule (unsigned 32-bit),
    expansion length of each rule (unsigned 64-bit),
    the symbols (unsigned, ``width`` bytes).

All integers are little-endian.  Expansion lengths give the place of each symbol
in the shard's ids, so ``expand`` reads any range of them without the rest.

Defined cases: a null or empty text has no ids besides the end id; documents of
equal id follow each other by a hash of their text, null ids come first;
repeated rows stay; one very long text fills a shard by itself; other columns
are ignored; an empty table gives an empty file and result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citytherm.llm.common import slices, stage, table
from citytherm.llm.wordcodes import Encoder, Vocabulary

_HEAD = struct.Struct("<4s4I")


@dataclass(frozen=True)
class Settings:
    vocabulary: Vocabulary = Vocabulary("word_bpe_49k.json", blank=True)
    terminals: int = 49_408       # ids below this are tokens
    end_id: int = 2
    shard_tokens: int = 1 << 17
    least: int = 12               # a pair with fewer occurrences is no rule
    gain: float = 0.02           # rounds end once one shortens the shard by less than this share
    rules_a_round: int = 4_096
    slice_bytes: int = 4 << 20    # encoding holds about 17 bytes of arrays for each of text


def _choose(keys: np.ndarray, counts: np.ndarray, size: int, most: int) -> np.ndarray:
    """The commonest pairs whose symbols play one role each: left, right, or
    both for a pair of one symbol with itself.  Indices into ``keys``."""
    order = np.argsort(-counts, kind="stable")
    role = bytearray(size)
    chosen = []
    for i, left, right in zip(order.tolist(), (keys[order] >> 32).tolist(), (keys[order] & 0xFFFFFFFF).tolist()):
        a, b = role[left], role[right]
        if left == right:
            if a:
                continue
            role[left] = 3
        elif a in (0, 1) and b in (0, 2):
            role[left], role[right] = 1, 2
        else:
            continue
        chosen.append(i)
        if len(chosen) >= most:
            break
    return np.array(chosen, np.int64)


def compress(ids: np.ndarray, s: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rules (k x 2 symbols), expansion length of each rule, remaining symbols."""
    symbols = ids.astype(np.int64)
    rules: list[np.ndarray] = []
    lengths = np.ones(s.terminals, np.int64)
    while len(symbols) > 1:
        pairs = (symbols[:-1] << 32) | symbols[1:]
        ordered = np.sort(pairs)
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(edge, append=len(ordered))
        common = counts >= s.least
        keys, counts = ordered[edge[common]], counts[common]
        size = len(lengths)
        pick = _choose(keys, counts, size, s.rules_a_round)
        if not len(pick):
            break
        keys = np.sort(keys[pick])
        left, right = keys >> 32, keys & 0xFFFFFFFF
        # only pairs of symbols that a rule has on these sides are looked up
        begins, ends = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        begins[left] = ends[right] = True
        at = np.flatnonzero(begins[symbols[:-1]] & ends[symbols[1:]])
        rule = np.searchsorted(keys, pairs[at])
        hit = keys[np.minimum(rule, len(keys) - 1)] == pairs[at]
        at, rule = at[hit], rule[hit]
        own = (left == right)[rule]
        if own.any():  # runs of one symbol: every other place
            run = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(rule) != 0)))
            start = np.flatnonzero(run)
            turn = np.arange(len(at)) - np.repeat(start, np.diff(start, append=len(at)))
            keep = ~own | (turn % 2 == 0)
            at, rule = at[keep], rule[keep]
        used, counted = np.unique(rule, return_counts=True)
        used = used[counted > 1]
        if not len(used):
            break
        number = np.full(len(keys), -1, np.int64)
        number[used] = size + np.arange(len(used))
        keep = number[rule] >= 0
        at, rule = at[keep], rule[keep]
        symbols[at] = number[rule]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        symbols = symbols[stay]
        rules.append(np.stack((left[used], right[used]), axis=1))
        lengths = np.concatenate((lengths, lengths[left[used]] + lengths[right[used]]))
        if len(at) < s.gain * len(stay):
            break
    table_ = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return table_, lengths[s.terminals:], symbols


def pack(rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, terminals: int) -> bytes:
    width = 2 if terminals + len(rules) <= 1 << 16 else 4
    return b"".join((_HEAD.pack(b"RPG1", len(rules), len(symbols), terminals, width),
                     rules.astype("<u4").tobytes(), lengths.astype("<u8").tobytes(), symbols.astype(f"<u{width}").tobytes()))


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    magic, n, m, terminals, width = _HEAD.unpack_from(payload)
    if magic != b"RPG1":
        raise ValueError("not a token file payload")
    at = _HEAD.size
    rules = np.frombuffer(payload, "<u4", 2 * n, at).reshape(n, 2).astype(np.int64)
    lengths = np.frombuffer(payload, "<u8", n, at + 8 * n).astype(np.int64)
    return rules, lengths, np.frombuffer(payload, f"<u{width}", m, at + 16 * n).astype(np.int64), terminals


def expand(payload: bytes, start: int = 0, count: int | None = None) -> np.ndarray:
    """ids ``start`` to ``start + count`` of a shard.  Only symbols that reach into the range are opened."""
    rules, lengths, symbols, terminals = unpack(payload)
    size = np.concatenate((np.ones(terminals, np.int64), lengths))
    place = np.zeros(len(symbols) + 1, np.int64)
    np.cumsum(size[symbols], out=place[1:])
    stop = int(place[-1]) if count is None else min(start + count, int(place[-1]))
    out = np.zeros(max(stop - start, 0), np.int32)
    if not len(out):
        return out
    first, last = np.searchsorted(place, start, side="right") - 1, np.searchsorted(place, stop)
    node, at = symbols[first:last], place[first:last] - start
    while len(node):
        leaf = node < terminals
        out[at[leaf]] = node[leaf]
        node, at = rules[node[~leaf] - terminals], at[~leaf]
        at = np.stack((at, at + size[node[:, 0]]), axis=1).ravel()
        node = node.ravel()
        inside = (at < len(out)) & (at + size[node] > 0)
        node, at = node[inside], at[inside]
    return out


class _Shard:
    """Documents whose ids wait for their shard to fill."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.names: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.tokens = 0

    def add(self, names: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ids.append(ids[ends[0]: ends[-1]])
        self.names.append(names)
        self.counts.append(np.diff(ends))
        self.tokens += int(ends[-1] - ends[0])


def _write(s: Settings):
    def shard_row(shard: _Shard, part: int, before: int) -> pa.RecordBatch:
        names, counts = pa.concat_arrays(shard.names), np.concatenate(shard.counts)
        payload = pack(*compress(np.concatenate(shard.ids), s), s.terminals)
        one = pa.array([0, len(names)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([shard.tokens], pa.int64()),
             pa.ListArray.from_arrays(one, names), pa.ListArray.from_arrays(one, pa.array(counts, pa.int64())),
             pa.array([payload], pa.binary())], ["part", "before", "n_tokens", "doc_ids", "counts", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before, shard = Encoder.of(s.vocabulary), TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", s.slice_bytes):
                ids, ends = encoder.encode(data, offsets)
                n = rows.num_rows
                full = np.insert(ids, ends[1:], s.end_id)
                ends = ends + np.arange(n + 1)
                names, row = rows.column(0), 0
                while row < n:
                    last = int(np.searchsorted(ends, ends[row] + s.shard_tokens - shard.tokens, side="left"))
                    last = min(max(last, row + 1), n)
                    shard.add(names.slice(row, last - row), full, ends[row: last + 1])
                    row = last
                    if shard.tokens >= s.shard_tokens:
                        yield shard_row(shard, part, before)
                        before, shard = before + shard.tokens, _Shard()
        if shard.names:
            yield shard_row(shard, part, before)
    return run


def write(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The shards of ``documents`` (doc_id, text), written: part, n_tokens, doc_ids,
    counts, payload, start (ids of all shards before)."""
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first("doc_id"), F.asc("__tie"), F.asc("__row")]
    named = (documents.select("doc_id", "text", F.xxhash64("text").alias("__tie"))
             .withColumn("__row", F.monotonically_increasing_id()))
    dealt = named.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    shards = stage(dealt.mapInArrow(_write(s), f"part int, before long, n_tokens long, doc_ids array<{kind}>, counts array<long>, payload binary"),
                   "token-files")
    # a shard knows the ids before it in its range; the ranges' totals are at most ``parts`` rows
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("__base"))
    return shards.join(F.broadcast(bases), "part").withColumn("start", F.col("__base") + F.col("before")).drop("__base")


def read(shards: DataFrame, wanted: str = "digest") -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, and the unsigned
    crc32 of its ids (``wanted`` "digest") or the ids themselves ("ids")."""
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    last = "ids_crc32 long" if wanted == "digest" else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                names, counts = row.column(1).flatten(), row.column(2).flatten().to_numpy()
                ids = expand(row.column(3)[0].as_py())
                ends = np.concatenate(([0], np.cumsum(counts)))
                if wanted == "digest":
                    raw, edge = ids.astype("<u4").tobytes(), (4 * ends).tolist()
                    value = pa.array([zlib.crc32(raw[a:b]) for a, b in zip(edge, edge[1:])], pa.int64())
                else:
                    value = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([names, pa.array(row.column(0)[0].as_py() + ends[:-1], pa.int64()), pa.array(counts, pa.int64()), value],
                                                 ["doc_id", "start", "n_tokens", last.split()[0]])

    return (shards.select("start", "doc_ids", "counts", "payload")
            .mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, {last}"))


def lookup(shards: DataFrame, places: DataFrame) -> DataFrame:
    """ids of stated documents (``places``: doc_id, start, n_tokens) by random
    access: only the symbols that cover them are opened."""
    kind = places.schema["doc_id"].dataType.simpleString()
    held = shards.select("part", "before", F.col("start").alias("__start"), F.col("n_tokens").alias("__size"), F.explode(F.array_distinct("doc_ids")).alias("__id"))
    at = (places.select("doc_id", F.col("start").alias("__at"), F.col("n_tokens").alias("__n"))
          .join(held, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__at") >= F.col("__start")) & (F.col("__at") < F.col("__start") + F.col("__size"))))
    found = at.join(shards.select("part", "before", "payload"), ["part", "before"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [expand(p, a, n) for p, a, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return found.select("doc_id", "payload", (F.col("__at") - F.col("__start")).alias("at"), "__n").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written files."""
    return read(write(table(spark, sf_dir, "documents")))
