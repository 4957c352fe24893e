"""Byte-level BPE: encode texts to token ids, decode ids to bytes.

Texts of up to ``chunk`` characters are pre-tokenised and encoded in one map.
Longer ones are cut into chunks with ``overlap`` characters on both sides that
are encoded as rows of their own, on as many tasks as there are chunks.  A match
of the pattern depends only on the text from its start on, so two runs over the
same text agree for good once they share one boundary.  A chunk keeps the pieces
that start between its first boundary at or after its own begin and its first
boundary at or after the next chunk's begin; the next chunk reports its first
boundary too.  Where the two reports agree for all neighbours the pieces are
joined in order.  Where they don't (a run without boundaries longer than the
overlap), the text is encoded whole.

Distinct pieces are encoded once per slice at most through a bounded table of the
worker, by the given ranks.  Decoding concatenates the bytes of the ids.

Defined cases: null and empty texts have no ids; ids that are null decode to
nothing; repeated rows and null or repeated ``doc_id`` are carried; other columns
are ignored unless asked for; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm import wordcodes
from citytherm.llm.common import slices, stage, table, tidy


@dataclass(frozen=True)
class Settings:
    ranks: str = "byte_bpe_50k.tiktoken"  # a name of public_tokenizers, read on each worker
    pattern: str = public_tokenizers.PATTERN
    chunk: int = 32_768
    overlap: int = 512
    cached_pieces: int = 500_000
    cached_length: int = 48
    slice_bytes: int = 4 << 20


class Decoder:
    """Bytes of ids, from the ranks alone; one per worker process."""

    held: dict = {}

    def __init__(self, s: Settings):
        of = wordcodes.ranks(s.ranks)
        entries = [b""] * (max(of.values()) + 1)
        for entry, i in of.items():
            entries[i] = entry
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))
        self.end = np.cumsum(self.size)
        self.raw = np.frombuffer(b"".join(entries), np.uint8)

    def bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids' bytes in a row, and where each id's bytes end."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.raw[np.repeat(self.end[ids] - end, size) + np.arange(end[-1] if len(end) else 0)], end

    @classmethod
    def of(cls, s: Settings) -> Decoder:
        if s not in cls.held:
            cls.held[s] = cls(s)
        return cls.held[s]


class Encoder:
    """Pieces and ids of texts; one per worker process."""

    held: dict = {}

    def __init__(self, s: Settings):
        self.settings = s
        self.find = regex.compile(s.pattern)
        self.table = wordcodes.Encoder.of(wordcodes.Vocabulary(s.ranks, pattern=s.pattern, table_pieces=s.cached_pieces, table_length=s.cached_length))

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of pieces and where each one's begin."""
        raw = [p.encode() for p in pieces]
        return self.table.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))

    @classmethod
    def of(cls, s: Settings) -> Encoder:
        if s not in cls.held:
            cls.held[s] = cls(s)
        return cls.held[s]


def _whole(s: Settings, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(s)
        for batch in batches:
            for part, data, offsets in slices(batch, "text", s.slice_bytes):
                ids, rows = encoder.table.encode(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in columns] + [pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids))], [*columns, "ids"])
    return run


def chunk_pieces(encoder: Encoder, text: str, begin: int, end: int, last: bool) -> tuple[int, int, list[str]]:
    """The pieces that a chunk keeps of its slice ``text``, after the first
    boundary at or after ``begin``, and the first at or after ``end`` (-1: none
    that can be relied on)."""
    spans = [m.span() for m in encoder.find.finditer(text)]
    limit = len(text) if last else len(text) - 3  # a match may look at 2 characters after its end
    starts = [a for a, b in spans if b <= limit]
    first = next((a for a in starts if a >= begin), -1)
    stop = len(text) if last else next((a for a in starts if a >= end), -1)
    if first < 0 or stop < 0:
        return (first, stop, []) if not (last and first < 0) else (len(text), len(text), [])
    return first, stop, [text[a:b] for a, b in spans if first <= a < stop]


def _chunks(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(s)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                firsts, stops, pieces, counts = [], [], [], []
                for row in part.select(["at", "n", "lead", "text"]).to_pylist():
                    base = row["at"] - row["lead"]
                    a, b, own = chunk_pieces(encoder, row["text"], row["lead"], row["lead"] + s.chunk, row["at"] + s.chunk >= row["n"])
                    firsts.append(a + base if a >= 0 else -1)
                    stops.append(b + base if b >= 0 else -1)
                    pieces += own
                    counts.append(len(own))
                ids, ends = encoder.ids(pieces)  # of all chunks at once
                bounds = ends[np.cumsum([0, *counts])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(firsts, pa.int64()), pa.array(stops, pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))],
                                                 ["key", "at", "first", "stop", "ids"])
    return run


def _long(texts: DataFrame, s: Settings) -> DataFrame:
    """key, ids of distinct long texts (key, text)."""
    size = F.char_length("text")
    cut = (texts.select("key", "text", size.alias("n"), F.explode(F.sequence(F.lit(0), size - 1, F.lit(s.chunk))).alias("at"))
           .withColumn("lead", F.least("at", F.lit(s.overlap)))
           .select("key", F.col("at").cast("long").alias("at"), F.col("n").cast("long").alias("n"), F.col("lead").cast("long").alias("lead"),
                   F.substring("text", F.col("at") - F.col("lead") + 1, F.col("lead") + s.chunk + s.overlap).alias("text")))
    parts = cut.repartition("key", "at").mapInArrow(tidy(_chunks(s)), "key string, at long, first long, stop long, ids array<int>")
    # written once: what fits and what does not read the same chunks
    joined = stage(parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "first", "stop", "ids"))).alias("c"))
              # neighbours agree on a boundary, and the first chunk starts at 0
              .withColumn("fits", F.expr("c[0].first = 0 AND forall(sequence(0, size(c) - 1), "
                                         "i -> c[i].stop >= 0 AND (i = 0 OR c[i].first = c[i - 1].stop))")), "chunks")
    whole = joined.where("fits").select("key", F.flatten(F.transform("c", lambda x: x["ids"])).alias("ids"))
    odd = joined.where("NOT fits").select("key").join(texts, "key")
    return whole.unionAll(odd.select("key", "text").mapInArrow(tidy(_whole(s, ["key"])), "key string, ids array<int>"))


def encode(documents: DataFrame, columns: list[str] | None = None, s: Settings = Settings()) -> DataFrame:
    """The given columns of ``documents`` with ``ids`` of the whole text."""
    columns = columns or ["doc_id"]
    named = documents.select(*dict.fromkeys([*columns, "text"]))
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    is_long = F.coalesce(F.char_length("text") > s.chunk, F.lit(False))
    short = named.where(~is_long).mapInArrow(tidy(_whole(s, columns)), f"{kinds}, ids array<int>")
    keyed = named.where(is_long).withColumn("__key", F.sha2("text", 256))
    texts = keyed.select(F.col("__key").alias("key"), "text").dropDuplicates(["key"])
    long = keyed.select(*columns, "__key").join(_long(texts, s), F.col("__key") == F.col("key")).select(*columns, "ids")
    return short.unionAll(long)


def decode(encoded: DataFrame, columns: list[str] | None = None, s: Settings = Settings()) -> DataFrame:
    """The given columns with ``bytes``: the concatenated bytes of ``ids``."""
    columns = columns or ["doc_id"]
    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder.of(s)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            counts = ids.value_lengths().fill_null(0).to_numpy()
            at = 0
            while at < batch.num_rows:  # runs of rows with a bounded number of ids
                n = max(int(np.searchsorted(np.cumsum(counts[at:]), s.slice_bytes // 4)), 1)
                part = batch.slice(at, n)
                values = ids.slice(at, n).flatten().drop_null().to_numpy().astype(np.int64)
                raw, end = decoder.bytes(values)
                rows = np.concatenate(([0], np.cumsum(ids.slice(at, n).is_valid().to_numpy(zero_copy_only=False) * counts[at: at + n])))
                if len(values) < rows[-1]:  # null ids inside lists
                    valid = np.concatenate(([0], np.cumsum(ids.slice(at, n).flatten().is_valid().to_numpy(zero_copy_only=False))))
                    rows = valid[rows]
                bounds = np.concatenate(([0], end))[rows].astype(np.int64)
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in columns] + [texts.cast(pa.binary())], [*columns, "bytes"])
                at += n

    return encoded.select(*dict.fromkeys([*columns, "ids"])).mapInArrow(tidy(run), f"{kinds}, bytes binary")


def digests(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded bytes."""
    ids = encode(documents, ["doc_id"], s).withColumn("n_tokens", F.size("ids").cast("long"))
    ids = ids.withColumn("ids_sha256", F.sha2(F.array_join("ids", " "), 256))
    return (decode(ids, ["doc_id", "n_tokens", "ids_sha256"], s)
            .select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text."""
    return digests(table(spark, sf_dir, "documents"))
