"""Remove repeated byte strings: merged shard Burrows-Wheeler transforms.

A string of ``WIDTH`` bytes that starts at two places, in one text or in two, is
a repeat; every byte that any repeat covers goes.  All is judged on the input.

*Bringing equal strings together.*  Every window of ``WIDTH`` bytes is named by
its anchor, the ``GRAM``-byte string in it with the least hash (leftmost of ties).
Equal windows have equal anchors at equal places, so windows whose anchor occurs
once in the whole corpus are unique, and all others meet under their anchor's
hash.  Neighbouring windows with one anchor travel as one segment; equal segments
are counted, not copied.  An anchor with very many different segments is split
further by the bytes that a block of its windows has in common.

*Judging.*  Within a task, segments are cut into blocks of windows that share
bytes; a block's string that no other string competes with is judged by its count.
All others fill shards of bounded size.  Each shard is sorted once and gives its transform (the byte
before each suffix in suffix order).  Shards are merged without sorting their
suffixes again: the interleave of all suffixes is refined through the transforms,
two symbols a pass, and the pass in which a suffix loses its last partner gives its
common prefix.  Suffixes that still share an interval after ``WIDTH`` symbols are repeats.

Defined cases: null texts are empty and lose nothing, as do texts under ``WIDTH``
bytes; texts with equal or null ``doc_id`` are told apart by a row number, so
repeated rows are copies of each other and lose everything from ``WIDTH`` bytes
on; overlapping repeats of one text count; other columns are carried when asked
for, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import _U, discard, mix, powers, prefix_hash, slices, stage, table, tidy

WIDTH = 200
GRAM = 48
PIECE = 1 << 19  # windows judged at a time, whatever a text's length
SHARD = 96 << 10  # bytes of segments in one shard
FLUSH = 32  # shards' worth of segments judged together
SPLIT = 256  # different segments of one anchor that are not split further
BLOCK = 64  # places of one block of windows
END = 0xFF  # never a byte of UTF-8


def anchors(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window start of ``data`` the place of its anchor, as runs:
    (first start, anchor place, anchor hash); a run ends where the next begins."""
    n = len(data) - width + 1
    inner = width - gram + 1
    prefix = prefix_hash(data)
    start = np.arange(len(data) - gram + 1)
    h = mix((prefix[gram:] - prefix[:-gram]) * powers(len(start))[1])
    ranked = (h & ~_U((1 << 21) - 1)) | start.astype(np.uint64)  # ties: leftmost
    full = -(-len(ranked) // inner) * inner
    padded = np.full(full, np.iinfo(np.uint64).max)
    padded[: len(ranked)] = ranked
    rows = padded.reshape(-1, inner)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:n], ahead[inner - 1: inner - 1 + n]) & _U((1 << 21) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return first, place[first], h[place[first]].astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first start in the row, windows, anchor place in the row, anchor hash)
    of all runs of a slice, piece by piece; windows never cross rows."""
    size = np.diff(offsets)
    last_start = offsets[1:] - WIDTH  # of each row
    for begin in range(0, max(len(data) - WIDTH + 1, 0), PIECE):
        part = data[begin: begin + PIECE + WIDTH - 1]
        first, place, h = anchors(part)
        end = np.append(first[1:], len(part) - WIDTH + 1)
        # cut the runs at row borders: a row's windows are [offset, last start]
        rows = np.arange(np.searchsorted(offsets, begin, "right") - 1, np.searchsorted(offsets, begin + len(part), "left"))
        rows = rows[size[rows] >= WIDTH]
        lo, hi = np.maximum(offsets[rows], begin) - begin, np.minimum(last_start[rows] + 1, begin + len(part) - WIDTH + 1) - begin
        rows, lo, hi = rows[hi > lo], lo[hi > lo], hi[hi > lo]
        a, b = np.searchsorted(end, lo, "right"), np.searchsorted(first, hi, "left")
        count = b - a
        run = np.repeat(a - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(rows) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(rows)), count)
        s, e = np.maximum(first[run], lo[of]), np.minimum(end[run], hi[of])
        base = offsets[rows[of]] - begin
        yield rows[of], s - base, e - s, place[run] - base, h[run]


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            ids = part.column(0).to_numpy()
            for row, _, _, place, h in runs(data, offsets):
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids[row]), pa.array(place.astype(np.int32))], ["h", "rid", "place"])


_SEGMENT = "h long, a long, b long, rid long, start int, lead int, seg binary"
_PIECE = "h long, k long, a long, b long, lead int, n long, seg binary, form_a long, form_b long, at int"


def _key(b: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(b, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], list(names))


def _emit_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the windows whose anchor is in ``places`` (rid, text, places)."""
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            ids = part.column(0).to_numpy()
            places = part.column(part.schema.get_field_index("places"))
            wanted = places.flatten().to_numpy() + np.repeat(offsets[:-1], places.value_lengths().to_numpy())
            raw = data.tobytes()
            for row, s, count, place, h in runs(data, offsets):
                hit = np.isin(place + offsets[row], wanted)
                out = []
                for r, at, n, x, p in zip(row[hit].tolist(), s[hit].tolist(), count[hit].tolist(), h[hit].tolist(), place[hit].tolist()):
                    seg = raw[offsets[r] + at: offsets[r] + at + n + WIDTH - 1]
                    out.append((x, *_key(seg), ids[r], at, p - at, seg))
                if out:
                    yield _batch(out, _SEGMENT)


def blocks(seg: bytes, lead: int) -> Iterator[tuple[int, int, bytes]]:
    """Cut a segment (anchor at ``lead``) into (from, to, name): windows whose
    places to the anchor fall into one block of ``BLOCK``.  The name holds the bytes
    that all windows of a block share, so equal windows have equal names."""
    windows = len(seg) - WIDTH + 1
    at = 0
    while at < windows:
        block = (lead - at) // BLOCK
        core = lead - block * BLOCK  # the last start that the block can hold
        to = min(core + 1, windows)
        yield at, to, block.to_bytes(2, "little") + seg[core: core + WIDTH - BLOCK + 1]
        at = to


def _split_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different segments (h, a, b, lead, n, seg) cut into blocks that meet only under one name (``k``)."""
    for batch in batches:
        out = []
        for h, a, b, lead, n, seg in zip(*(c.to_pylist() for c in batch.columns)):
            for at, to, name in blocks(seg, lead):
                piece = seg[at: to + WIDTH - 1]
                out.append((h, _key(name)[0], *_key(piece), lead - at, n, piece, a, b, at))
            if len(out) > 2000:
                yield _batch(out, _PIECE)
                out = []
        if out:
            yield _batch(out, _PIECE)


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotation order of ``text`` and its Burrows-Wheeler transform."""
    n = len(text)
    at = np.arange(n)
    packed = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        packed = (packed << _U(8)) | text[(at + j) % n].astype(np.uint64)
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
    step = 8
    while True:
        order = np.argsort(rank * n + np.roll(rank, -step % n)) if n else at
        key = rank[order] * n + rank[(order + step) % n]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        if new.max(initial=0) == n - 1 or step >= n:
            return order, text[order - 1]
        rank, step = new, step * 2


def merge(shards: list[tuple[np.ndarray, np.ndarray]], depth: int = WIDTH, ends: np.ndarray | None = None) -> np.ndarray:
    """Common prefixes of the suffixes of several shards, from the shards'
    (order, transform) alone: for each shard's places, one shard after the other,
    the longest prefix (even, at most ``depth``, within one string) that another
    suffix shares.

    The interleave lists suffixes by their first d symbols, in blocks that agree on
    all of them.  A pass reads the two symbols before each suffix from the
    transforms and deals the suffixes to these stably: the interleave for d + 2.
    A block splits where symbols differ; suffixes left alone, or that meet the end of a
    string, have no longer prefix in common and leave.

    ``ends`` (for each place, shard after shard) marks the places where a string of
    ``depth`` symbols ends: only their suffixes start, so each pass holds as many suffixes
    as there are such strings, and only prefixes of the whole depth are told.
    """
    sizes = [len(t) for _, t in shards]
    begin = np.concatenate(([0], np.cumsum(sizes)))
    before = np.concatenate([t for _, t in shards])  # symbol before each suffix, shard by shard in suffix order
    step = np.empty(begin[-1], dtype=np.int64)  # the suffix that is one symbol longer
    place = np.empty(begin[-1], dtype=np.int64)
    for (order, _), n, at in zip(shards, sizes, begin):
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        step[at: at + n] = rank[order - 1] + at
        place[at: at + n] = order + at
    pair = before[step].astype(np.uint16) << 8 | before
    ended = (before == END) | (before[step] == END)
    step = step[step].astype(np.int32)
    common = np.zeros(begin[-1], dtype=np.int16)
    now = (np.arange(begin[-1]) if ends is None else np.flatnonzero(ends[place])).astype(np.int32)  # the interleave, all in one block
    block = np.zeros(len(now), dtype=np.int32)
    for d in range(2, depth + 1, 2):
        going = ~ended[now]
        now, block = now[going], block[going]
        symbol = pair[now]
        order = np.argsort(symbol, kind="stable")
        symbol, block, now = symbol[order], block[order], step[now[order]]
        new = np.ones(len(now) + 1, dtype=bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        shared = ~(new[:-1] & new[1:])
        now, block = now[shared], np.cumsum(new[:-1], dtype=np.int32)[shared]
        if not len(now):
            break
        common[now] = d
    out = np.empty(begin[-1], dtype=np.int16)
    out[place] = common
    return out


def repeated(groups: list[list[tuple[bytes, int]]], shard: int = SHARD) -> list[list[np.ndarray]]:
    """For groups of different strings (bytes, weight): which window starts of
    each string begin a repeat.  Windows of different groups are never equal."""
    flat = [(g, i, seg, weight) for g, group in enumerate(groups) for i, (seg, weight) in enumerate(group)]
    shards = min(max(2, -(-sum(len(x[2]) + 1 for x in flat) // shard)), max(len(flat), 1))
    dealt = [flat[s::shards] for s in range(shards)]  # every group is spread over the shards
    # a window of a string ends at its place WIDTH or later, its closing symbol included
    size = np.array([len(x[2]) + 1 for own in dealt for x in own], dtype=np.int64)
    ends = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) >= WIDTH
    common = merge([transform(np.frombuffer(b"".join(x[2] + bytes([END]) for x in own), dtype=np.uint8)) for own in dealt], WIDTH, ends)
    out = [[np.zeros(0, bool)] * len(g) for g in groups]
    at = 0
    for own in dealt:
        for g, i, seg, weight in own:
            out[g][i] = (common[at: at + len(seg) - WIDTH + 1] >= WIDTH) | (weight >= 2)
            at += len(seg) + 1
    return out


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments (h, k, a, b, lead, n, seg) sorted by (h, k) -> (h, k, a, b, marks):
    [from, to) pairs of starts of repeats."""
    def cut(group: list) -> dict:
        """Blocks of a group's segments: name -> {bytes: [weight, places]}."""
        named: dict = {}
        for i, (_, _, lead, w, seg) in enumerate(group):
            for at, to, name in blocks(seg, lead):
                own = named.setdefault(name, {}).setdefault(seg[at: to + WIDTH - 1], [0, []])
                own[0] += w
                own[1].append((i, at))
        return named

    def flush(groups: list) -> Iterator[pa.RecordBatch]:
        marks = [[np.full(len(x[4]) - WIDTH + 1, x[3] >= 2) for x in g] for _, g in groups]
        open_sets, places = [], []
        for at, (_, group) in enumerate(groups):
            if len(group) > 1:
                for own in cut(group).values():
                    if len(own) == 1:  # one string under this name: its weight decides
                        (_, (w, where)), = own.items()
                        if w >= 2:
                            piece, = own
                            for i, start in where:
                                marks[at][i][start: start + len(piece) - WIDTH + 1] = True
                    else:
                        open_sets.append([(piece, w) for piece, (w, _) in own.items()])
                        places.append((at, [where for _, where in own.values()]))
        for found, (at, where) in zip(repeated(open_sets) if open_sets else [], places):
            for again, spots in zip(found, where):
                for i, start in spots:
                    marks[at][i][start: start + len(again)] |= again
        rows = []
        for (key, group), own in zip(groups, marks):
            for (a, b, *_), again in zip(group, own):
                if again.any():
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], again.view(np.int8), [0]))))
                    rows.append((*key, a, b, edge.astype(np.int32).tolist()))
        if rows:
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["h", "k", "a", "b", "marks"])

    groups, held, last = [], 0, None
    for batch in batches:
        for h, k, a, b, lead, n, seg in zip(*(c.to_pylist() for c in batch.columns)):
            if (h, k) != last:
                if held > FLUSH * SHARD:
                    yield from flush(groups)
                    groups, held = [], 0
                groups.append(((h, k), []))
                last = (h, k)
            groups[-1][1].append((a, b, lead, n, seg))
            held += len(seg)
    if groups:
        yield from flush(groups)


def _marked(counted: DataFrame) -> DataFrame:
    """(h, k, a, b, marks) of different pieces (h, k, a, b, lead, n, seg) with repeats."""
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (counted.select("h", "k", "a", "b", "lead", "n", "seg").repartition(parts, "h", "k").sortWithinPartitions("h", "k")
            .mapInArrow(tidy(_judge), "h long, k long, a long, b long, marks array<int>"))


def numbered(documents: DataFrame) -> DataFrame:
    """Add ``__rid``, unique per row: the id itself, or a row number where ids are
    null or repeat (then the rows are written first, so the numbers hold)."""
    ids = documents.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("k")).first()
    if ids["n"] == ids["k"]:
        return documents.withColumn("__rid", F.col("doc_id").cast("long"))
    return stage(documents.withColumn("__rid", F.monotonically_increasing_id()), "numbered")


def repeats(texts: DataFrame) -> DataFrame:
    """(rid, cuts): for texts (rid, text) the byte ranges [start, end) of runs of
    repeats, not yet joined; only texts with repeats."""
    found = texts.select("rid", "text").mapInArrow(tidy(_emit_anchors), "h long, rid long, place int")
    # written first: both sides of the join are then plain exchanges, and a hot anchor's rows can be split
    common = stage(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "anchors")
    hits = found.join(common, "h").groupBy("rid").agg(F.collect_list("place").alias("places"))
    segments = stage(texts.join(hits, "rid").select("rid", "text", "places").mapInArrow(tidy(_emit_segments), _SEGMENT), "segments")
    # copies of a segment are counted first (partial sums in each task) and travel once from here on
    forms = stage(segments.groupBy("h", "a", "b", "lead", "seg").agg(F.count("*").alias("n")), "forms")
    crowd = stage(forms.groupBy("h").count().where(f"count > {SPLIT}").select("h"), "crowd")
    pieces = stage(forms.join(crowd, "h").select("h", "a", "b", "lead", "n", "seg").mapInArrow(tidy(_split_forms), _PIECE), "pieces")
    plain = forms.join(crowd, "h", "left_anti").withColumn("k", F.lit(0).cast("long"))
    split = pieces.groupBy("h", "k", "a", "b", "lead", "seg").agg(F.sum("n").alias("n"))
    marked = stage(_marked(plain.select("h", "k", "a", "b", "lead", "n", "seg").unionByName(split)), "marks")
    # the pieces' marks, moved to their places in the segments they come from
    spans = F.transform(F.sequence(F.lit(0), F.size("marks") - 1, F.lit(2)), lambda i: F.struct(
        (F.col("at") + F.get("marks", i)).alias("start"), (F.col("at") + F.get("marks", i + 1) + (WIDTH - 1)).alias("end")))
    of_pieces = pieces.select("h", "k", "a", "b", "form_a", "form_b", "at").join(marked, ["h", "k", "a", "b"])
    of_plain = marked.join(crowd, "h", "left_anti").select("h", F.col("a").alias("form_a"), F.col("b").alias("form_b"), F.lit(0).alias("at"), "marks")
    found = (of_plain.unionByName(of_pieces.select("h", "form_a", "form_b", "at", "marks"))
             .select("h", F.col("form_a").alias("a"), F.col("form_b").alias("b"), spans.alias("spans"))
             .groupBy("h", "a", "b").agg(F.flatten(F.collect_list("spans")).alias("spans")))  # a segment's own pieces
    found = stage(found, "spans")  # written: the join with a segment of very many copies can then be split
    ranges = (segments.select("h", "a", "b", "rid", "start").join(found, ["h", "a", "b"])
              .select("rid", "start", F.explode("spans").alias("span"))
              .select("rid", F.struct((F.col("start") + F.col("span.start")).alias("start"), (F.col("start") + F.col("span.end")).alias("end")).alias("cut")))
    cuts = stage(ranges.groupBy("rid").agg(F.sort_array(F.collect_list("cut")).alias("cuts")), "cuts")
    for done in (segments, forms, pieces, marked, crowd, common, found):
        discard(done)
    return cuts


def _cut(columns: list[str], as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                cuts = part.column(part.schema.get_field_index("__cuts"))
                removed, spans, kept = [], [], []
                for i in range(part.num_rows):
                    own = data[offsets[i]: offsets[i + 1]]
                    gone = np.zeros(len(own) + 2, dtype=np.int32)
                    if cuts[i].is_valid:
                        flat = cuts.slice(i, 1).flatten()
                        np.add.at(gone, flat.field("start").to_numpy() + 1, 1)
                        np.add.at(gone, flat.field("end").to_numpy() + 1, -1)
                    inside = np.cumsum(gone) > 0
                    spans.append(int((inside[1:] & ~inside[:-1]).sum()))
                    keep = ~inside[1: len(own) + 1]
                    removed.append(len(own) - int(keep.sum()))
                    rest = own[keep].tobytes()
                    kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in columns]
                    + [pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())],
                    [*columns, "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def deduplicate(documents: DataFrame, columns: list[str], as_text: bool = False) -> DataFrame:
    """The given columns with n_bytes, n_removed, n_spans and the bytes ``kept``;
    with ``as_text`` a string without the bytes of characters that were cut in two."""
    rows = numbered(documents.select(*dict.fromkeys([*columns, "doc_id", "text"])))
    cuts = repeats(rows.select(F.col("__rid").alias("rid"), "text"))
    joined = rows.join(cuts.select(F.col("rid").alias("__rid"), F.col("cuts").alias("__cuts")), "__rid", "left")
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    return joined.select(*dict.fromkeys([*columns, "text"]), "__cuts").mapInArrow(tidy(
        _cut(columns, as_text)), f"{kinds}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document and a digest of the rest."""
    out = deduplicate(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
