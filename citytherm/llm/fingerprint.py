"""Document fingerprints from closed syncmers.

A text is read as characters, white space and all.  A window of ``k`` characters
is an anchor when the smallest hash among its ``k - s + 1`` inner windows of ``s``
characters stands first or last.  Whether a window is an anchor depends on the
window alone, so an edit changes only the anchors whose characters it touches,
also in text without spaces.  The fingerprint lists the 32-bit hashes of all
anchors in text order, 8 hex digits each.

Any ``2 * k - s - 1`` characters in a row hold an anchor.  Shorter texts are read
with a smaller ``k`` (``LEVELS``), so that three quarters of any text hold one.

Likeness of two fingerprints is the Dice share ``2 * common / (a + b)`` of their
distinct anchors; a text is read at the level of the shorter one to be compared.

``anchors``, ``level`` and ``at_level`` are built-in expressions for any column.  They
interpret an array element by element, which costs too much for whole corpora;
``compare`` computes the same hashes over Arrow batches, and tests hold the two
against each other.

The next document in id order is found without a global sort in one task: rows
are dealt to ranges of (id, text) and sorted there, so a row's successor is the next
row; the last row of a range meets the first one of the next range through a table
with two rows for each range.

Defined cases: null and empty texts count as empty, with an empty fingerprint;
two empty fingerprints have likeness 1, an empty and a filled one 0; for ``anchors``
alone, a text without any has one, the hash of all its characters; rows that tie on ``doc_id`` are ordered by text, and a null
``doc_id`` comes before all others; with one document the next one is itself;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import let, table

K, S = 24, 4
TOKEN = "(?s)."  # one character
LEVELS = ((2, 1, 0), (4, 1, 8), (8, 2, 17), (K, S, 57))  # k, s and the least number of characters: three quarters hold 2 * k - s - 1


def _characters(text: Column) -> Column:
    return F.transform(F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "")), lambda t: F.xxhash64(t))


def _lowest(small: Column, inner: int) -> Column:
    """At each place the smallest of ``inner`` values from there on: runs of 1, 2, 4 ... joined."""
    def join(step: int):
        return lambda o: F.zip_with(o, F.slice(o, step + 1, F.size(o)), lambda a, b: F.least(a, b))

    out, width = small, 1
    while width < inner:
        step = min(width, inner - width)
        out, width = let(out, join(step)), width + step
    return out


def _places(tokens: Column, k: int, s: int) -> Column:
    """Places of the closed syncmers, from 0."""
    inner = k - s + 1
    small = F.transform(tokens, lambda _, i: F.xxhash64(*[F.get(tokens, i + j) for j in range(s)]))

    def pick(small: Column) -> Column:
        return F.filter(F.transform(_lowest(small, inner), lambda low, i: F.when((low == F.get(small, i)) | (low == F.get(small, i + inner - 1)), i)),
                        lambda i: i <= F.size(tokens) - k)
    return F.when(F.size(tokens) >= k, let(small, pick)).otherwise(F.array().cast("array<int>"))


def _hashes(tokens: Column, places: Column, k: int) -> Column:
    return F.transform(places, lambda i: F.shiftright(F.xxhash64(*[F.get(tokens, i + j) for j in range(k)]), 32).cast("int"))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<int>: anchor hashes of a text in text order."""
    def whole(tokens: Column) -> Column:
        found = _hashes(tokens, _places(tokens, k, s), k)
        return let(found, lambda a: F.when((F.size(a) > 0) | (F.size(tokens) == 0), a).otherwise(F.array(F.shiftright(F.xxhash64(tokens), 32).cast("int"))))
    return let(_characters(text), whole)


def level(text: Column) -> Column:
    """The index in ``LEVELS`` at which a text is read."""
    out, n = F.lit(0), F.char_length(text)
    for i, (_, _, least) in enumerate(LEVELS[1:], 1):
        out = F.when(n >= least, i).otherwise(out)
    return out


def at_level(text: Column, level: Column, levels: int = len(LEVELS)) -> Column:
    """Anchors of a text read at a level, one of the first ``levels``."""
    out = F.when(level == 0, anchors(text, *LEVELS[0][:2]))
    for i, (k, s, _) in enumerate(LEVELS[1:levels], 1):
        out = out.when(level == i, anchors(text, k, s))
    return out


def text_of(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda a: F.lower(F.lpad(F.right(F.hex(a), F.lit(8)), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Dice share of distinct values; 1 for two empty lists."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, 1.0).otherwise(2.0 * both / total)


# ---------------------------------------------------------------- whole tables, in tasks

_U = np.uint64
_P1, _P2, _P3, _P4, _P5 = (_U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
LEAD = 64  # characters of a text that take part in dealing rows of one id to ranges
BLOCK = 1 << 18  # windows worked on at once, so that memory follows the block and not the text


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x << _U(r)) | (x >> _U(64 - r))


def _hash_long(value: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """The 64-bit hash of one long that ``xxhash64`` chains."""
    h = (seed + _P5 + _U(8)) ^ (_turn(value * _P2, 31) * _P1)
    h = _turn(h, 27) * _P1 + _P4
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def _chain(tokens: np.ndarray, at: np.ndarray | slice, n: int) -> np.ndarray:
    """Hash of ``n`` tokens from each place on."""
    h: np.ndarray | np.uint64 = _U(42)
    for j in range(n):
        part = tokens[at.start + j: at.stop + j] if isinstance(at, slice) else tokens[at + j]
        h = _hash_long(part, h)
    return h


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all characters in a row, and the row offsets."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    known, code = np.unique(points, return_inverse=True)
    table_ = np.array([xxhash.xxh64_intdigest(chr(c).encode(), seed=42) for c in known.tolist()], np.uint64)
    return table_[code] if len(points) else np.zeros(0, np.uint64), np.cumsum([0, *map(len, texts)])


def _scan(tokens: np.ndarray, k: int, s: int) -> np.ndarray:
    """Places of the closed syncmers of all windows, in blocks."""
    inner, found = k - s + 1, []
    for begin in range(0, len(tokens) - k + 1, BLOCK):
        stop = min(begin + BLOCK, len(tokens) - k + 1)
        small = _chain(tokens, slice(begin, stop + inner - 1), s).view(np.int64)
        low, width = small, 1
        while width < inner:
            step = min(width, inner - width)
            low, width = np.minimum(low[:-step], low[step:]), width + step
        n = stop - begin
        found.append(np.flatnonzero((low == small[:n]) | (low == small[inner - 1: inner - 1 + n])) + begin)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def read_texts(texts: list[str], levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes of all texts, each at its level, and the row offsets: ``at_level`` for many rows."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for lv, (k, s, _) in enumerate(LEVELS):
        mine = np.flatnonzero(levels == lv)
        if not len(mine):
            continue
        tokens, ends = _codes([texts[i] for i in mine.tolist()])
        at = _scan(tokens, k, s)
        row = np.searchsorted(ends, at, side="right") - 1
        inside = at + k <= ends[row + 1]
        at, row = at[inside], row[inside]
        value = (_chain(tokens, at, k).view(np.int64) >> 32).astype(np.int32) if len(at) else np.zeros(0, np.int32)
        none = np.flatnonzero((np.bincount(row, minlength=len(mine)) == 0) & (np.diff(ends) > 0))
        for r in none.tolist():  # short texts without an anchor: all their characters
            h = _U(42)
            for t in tokens[ends[r]: ends[r + 1]]:
                h = _hash_long(np.array([t], np.uint64), h)
            value = np.append(value, (h.view(np.int64) >> 32).astype(np.int32))
            row = np.append(row, r)
        parts.append((mine[row], value))
    row, value = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int32))
    order = np.argsort(row, kind="stable")
    return value[order], np.searchsorted(row[order], np.arange(len(texts) + 1))


def _levels(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted([least for *_, least in LEVELS[1:]], sizes, side="right")


def _distinct(found: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sorted (place in ``rows``, hash) keys of the chosen rows' distinct anchors."""
    value, ends = found
    size = ends[rows + 1] - ends[rows]
    at = np.repeat(ends[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return np.unique((np.repeat(np.arange(len(rows)), size).astype(np.int64) << 32) | (value[at].astype(np.int64) & 0xFFFFFFFF))


def _dice(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    both = np.bincount(np.intersect1d(a, b, assume_unique=True) >> 32, minlength=n)
    total = np.bincount(a >> 32, minlength=n) + np.bincount(b >> 32, minlength=n)
    return np.where(total == 0, 1.0, 2.0 * both / np.maximum(total, 1))


_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def _hex(found: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    value, ends = found
    digits = _DIGITS[(value.view(np.uint32)[:, None] >> np.arange(28, -1, -4, dtype=np.uint32)) & 15]
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(8 * ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(digits))).cast(pa.string())


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(names: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Rows of ``compare`` from texts and the texts that follow them."""
    n = len(texts)
    edited = [t[: len(t) - len(t) // 4] + f[: len(t) // 4] for t, f in zip(texts, following)]
    own, changed, after = (_levels(np.fromiter(map(len, x), np.int64, n)) for x in (texts, edited, following))
    rows = np.arange(n)
    a, e = read_texts(texts, own), read_texts(edited, changed)
    lower = np.minimum(own, after)

    def at(found, texts, had, wanted):
        """Distinct anchors at the wanted levels: read again only where they are not at hand."""
        same = had == wanted
        again = np.flatnonzero(~same)
        keys = _distinct(found, rows)
        if not len(again):
            return keys
        more = _distinct(read_texts([texts[i] for i in again.tolist()], wanted[again]), np.arange(len(again)))
        return np.sort(np.concatenate((keys[same[keys >> 32]], (again[more >> 32].astype(np.int64) << 32) | (more & 0xFFFFFFFF))))
    near_edited = _dice(at(a, texts, own, np.minimum(own, changed)), at(e, edited, changed, np.minimum(own, changed)), n)
    # most texts that follow are the next row's own
    chained = following[:-1] == texts[1:] if n > 1 else False
    if chained:
        last = read_texts(following[-1:], after[-1:])
        f = (np.concatenate((a[0][a[1][1]:], last[0])), np.append(a[1][1:], a[1][-1] + len(last[0])) - a[1][1])
    else:
        f = read_texts(following, after)
    near_next = _dice(at(a, texts, own, lower), at(f, following, after, lower), n)
    return pa.RecordBatch.from_arrays(
        [names, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
         _hex(a), _hex(e), pa.array(near_edited), pa.array(near_next)], [c.split()[0] for c in _OUT.split(", ")])


def _slices(batches: Iterator[pa.RecordBatch], limit: int = 1 << 18) -> Iterator[tuple[pa.Array, list[str]]]:
    """(doc ids, texts) of runs of rows with about ``limit`` bytes of text."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        at = 0
        while at < batch.num_rows:
            stop = max(int(np.searchsorted(size, (size[at - 1] if at else 0) + limit)), at + 1)
            part = batch.slice(at, stop - at)
            yield part.column(0), part.column(1).to_pylist()
            at = stop


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a sorted partition but the last, which has no successor here."""
    held: tuple[pa.Array, str] | None = None
    for names, texts in _slices(batches):
        if held is not None:
            names, texts = pa.concat_arrays([held[0], names]), [held[1], *texts]
        if len(texts) > 1:
            yield _compared(names[:-1], texts[:-1], texts[1:])
        held = (names[-1:], texts[-1])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row of a sorted partition, named by the first one's
    place in the order, which no other range has."""
    first, last = None, None
    for batch in batches:
        if batch.num_rows:
            first = first if first is not None else batch.slice(0, 1)
            last = batch.slice(batch.num_rows - 1, 1)
    if first is not None:
        names = pa.concat_arrays([first.column(0)] * 2)
        lead = first.column(1)[0].as_py()[:LEAD]
        yield pa.RecordBatch.from_arrays([names, pa.array([lead, lead]), pa.array([True, False]), *(pa.concat_arrays([first.column(i), last.column(i)]) for i in (0, 1))],
                                         ["range_id", "range_text", "first", "doc_id", "text"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _compared(batch.column(0).slice(i, 1), [batch.column(1)[i].as_py()], [batch.column(2)[i].as_py()])


def compare(documents: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("text")]
    dealt = (rows.repartitionByRange(parts, F.asc_nulls_first("doc_id"), F.asc(F.substring("text", 1, LEAD)))
             .sortWithinPartitions(*order))
    ends = dealt.mapInArrow(_ends, "range_id long, range_text string, first boolean, doc_id long, text string")
    # one short entry for each range: the range that follows, and the first after the last
    used = ends.where("first").agg(F.sort_array(F.collect_list(F.struct("range_id", "range_text"))).alias("r"))
    then = lambda r, i: F.get("r", (i + 1) % F.size("r"))
    follows = used.select(F.inline(F.transform("r", lambda r, i: F.struct(
        r["range_id"].alias("a_id"), r["range_text"].alias("a_text"), then(r, i)["range_id"].alias("b_id"), then(r, i)["range_text"].alias("b_text")))))
    heads = ends.where("first").select(F.col("range_id").alias("h_id"), F.col("range_text").alias("h_text"), F.col("text").alias("next_text"))
    tails = (ends.where("NOT first")
             .join(follows, F.col("range_id").eqNullSafe(F.col("a_id")) & (F.col("range_text") == F.col("a_text")))
             .join(heads, F.col("b_id").eqNullSafe(F.col("h_id")) & (F.col("b_text") == F.col("h_text")))
             .select("doc_id", "text", "next_text").mapInArrow(_pairs, _OUT))
    return dealt.mapInArrow(_inside, _OUT).unionAll(tails)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited form."""
    return compare(table(spark, sf_dir, "documents"))
