"""Benchmark decontamination: containment search for short items in long documents.

An item leaks into a document when at least ``percent`` of the item's distinct
5-word shingles occur in the document.

*Signatures.*  An item of q shingles is known by its ``q // 4 + 1`` smallest
shingle hashes, a bottom-k MinHash sample that grows with the item.  A document
that holds 75 in 100 of the shingles misses at most ``q // 4`` of them, so it
holds at least one hash of the signature: the search loses nothing, however long the
document is.

*Size partitions.*  Items are parted by set size into powers of two.  A document
of n shingles meets only partitions whose smallest item can fit
(``100 * n >= percent * size``), so short texts skip long items.

*Check.*  Each (document, item) with a signature hit is decided by exact
containment over the sets of 5-word tuples, not their hashes.

The benchmark is measured first.  Items go to the tasks in blocks of at most
``block_bytes`` of text, so what is broadcast is bounded whatever the
benchmark's size; the documents are read once for each block (one block for any
usual benchmark), never shuffled.

Defined cases: null, empty and blank texts on either side match nothing; texts of
1 to 4 words have one shingle, their whole word sequence; items with equal texts
match alike; repeated document rows are reported each; null ids are carried;
other columns are ignored; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import SHINGLE_WORDS, shingles, slices, table, tidy, utf8

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


@dataclass(frozen=True)
class Settings:
    percent: int = 75
    block_bytes: int = 16 << 20


@dataclass(frozen=True)
class Block:
    """Signatures of a bounded set of items, parted by set size."""
    ids: list
    texts: list[str]
    parts: list[tuple[int, np.ndarray, np.ndarray]]  # smallest size; sorted hashes; item of each


def shingle_tuples(text: str) -> set[tuple[str, ...]]:
    w = _WORD.findall(text.translate(_LOWER))
    if len(w) < SHINGLE_WORDS:
        return {tuple(w)} if w else set()
    return {tuple(w[i: i + SHINGLE_WORDS]) for i in range(len(w) - SHINGLE_WORDS + 1)}


def block_of(ids: list, texts: list[str], s: Settings) -> Block:
    sets = shingles(*utf8(pa.array(texts, pa.string())))
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    parts = []
    for power in range(int(sizes.max(initial=0)).bit_length()):
        own = np.flatnonzero((sizes >= 1 << power) & (sizes < 2 << power))
        if len(own):
            keep = [sets[i][: len(sets[i]) * (100 - s.percent) // 100 + 1] for i in own]  # sets are sorted
            h, item = np.concatenate(keep), np.repeat(own, [len(x) for x in keep])
            order = np.argsort(h, kind="stable")
            parts.append((int(sizes[own].min()), h[order], item[order]))
    return Block(ids, texts, parts)


def _hits(own: np.ndarray, h: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Items that share a signature hash with the sorted set ``own``."""
    if len(own) < len(h):
        lo, hi = np.searchsorted(h, own, "left"), np.searchsorted(h, own, "right")
        return np.concatenate([item[a:b] for a, b in zip(lo[hi > lo], hi[hi > lo])] or [item[:0]])
    at = np.minimum(np.searchsorted(own, h), len(own) - 1)
    return item[own[at] == h]


def _blocks(benchmark: DataFrame, s: Settings) -> Iterator:
    """The benchmark as broadcast blocks of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    count = -(-size * 2 // s.block_bytes)  # hash blocks, half full on average
    for b in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        held = part.collect()  # at most about block_bytes
        if any(r["text"] for r in held):
            yield spark.sparkContext.broadcast(block_of([r["item_id"] for r in held], [r["text"] for r in held], s))


def _leaks(batches: Iterator[pa.RecordBatch], block: Block, s: Settings) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, int, int]]]]:
    """Slices of rows with their leaks (row, item, item's shingles, shared)."""
    tuples = [shingle_tuples(t) for t in block.texts]
    for batch in batches:
        for part, data, offsets in slices(batch, "text"):
            texts, found = part.column(part.schema.get_field_index("text")), []
            for row, own in enumerate(shingles(data, offsets)):
                near = [_hits(own, h, item) for least, h, item in block.parts if 100 * len(own) >= s.percent * least]
                near = np.unique(np.concatenate(near)) if near else ()
                if len(near):
                    mine = shingle_tuples(texts[row].as_py())
                    for i in near:
                        both = len(tuples[i] & mine)
                        if 100 * both >= s.percent * len(tuples[i]):
                            found.append((row, i, len(tuples[i]), both))
            yield part, found


def search(documents: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared for every leak."""
    schema = (f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, "
              "n_item_shingles long, n_shared long")

    def pairs(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, found in _leaks(batches, held.value, s):
                if found:
                    row, item, size, both = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row)), pa.array([held.value.ids[i] for i in item]), pa.array(size, pa.int64()),
                         pa.array(both, pa.int64())], ["doc_id", "item_id", "n_item_shingles", "n_shared"])
        return run
    out = None
    for held in _blocks(benchmark, s):
        now = documents.select("doc_id", "text").mapInArrow(tidy(pairs(held)), schema)
        out = now if out is None else out.unionAll(now)
    return out if out is not None else documents.sparkSession.createDataFrame([], schema)


def clean(documents: DataFrame, benchmark: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``documents`` that hold no item, whatever their other columns."""
    def rest(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, found in _leaks(batches, held.value, s):
                hit = {f[0] for f in found}
                yield part.take(pa.array([i for i in range(part.num_rows) if i not in hit], pa.int64()))
        return run
    for held in _blocks(benchmark, s):
        documents = documents.mapInArrow(tidy(rest(held)), documents.schema)
    return documents


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item into a document."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x20\x09-\x0D]+') AS w FROM documents),
     i AS (SELECT item_id, row_number() OVER () AS iid,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x20\x09-\x0D]+') AS w FROM benchmark),
     ds AS (SELECT DISTINCT doc_id, rid, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
              ELSE [array_to_string(w[k:k+4], ' ') FOR k IN range(1, len(w) - 3)] END) AS s FROM d),
     s AS (SELECT DISTINCT item_id, iid, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
              ELSE [array_to_string(w[k:k+4], ' ') FOR k IN range(1, len(w) - 3)] END) AS s FROM i),
     n AS (SELECT iid, count(*) AS n FROM s GROUP BY iid)
SELECT doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared
FROM s JOIN ds USING (s) JOIN n USING (iid)
GROUP BY doc_id, rid, item_id, iid, n HAVING 100 * count(*) >= 75 * n
"""
