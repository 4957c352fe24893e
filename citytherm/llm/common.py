"""Shared helpers: table access, stage tables, vectorised word and shingle hashes.

The hash helpers work on one Arrow batch inside a task.  A batch is cut into
slices of about ``SLICE_BYTES`` (whole documents), so a worker's memory follows
the slice or the longest single text, never the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.session import shared_dir

SLICE_BYTES = 2 << 20
SHINGLE_WORDS = 5

_U = np.uint64
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (wrapping arithmetic): every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _keys(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + _U(seed)) * _U(0x9E3779B97F4A7C15)) | _U(1)


_BYTE = _keys(256, 11)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; tables grow on demand and go with ``give_back``."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n + n // 8, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            _POWERS[name] = np.multiply.accumulate(step)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(data: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """S with hash(data[i:j]) = (S[j] - S[i]) * base**-i (see ``range_hash``)."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (data[offsets[0]: offsets[-1]], offsets - offsets[0]) if len(column) else (data[:0], np.zeros(1, np.int64))


def slices(batch: pa.RecordBatch, column: str, limit: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole rows with about ``limit`` bytes of text each."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    for row, last in runs(offsets, limit or SLICE_BYTES):
        yield batch.slice(row, last - row), data[offsets[row]: offsets[last]], offsets[row: last + 1] - offsets[row]
    give_back()


def runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """First row and end of every run of whole rows with about ``limit`` bytes; a longer row is a run of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), n)
        yield row, last
        row = last


def give_back() -> None:
    """Return freed memory to the system: reused workers would keep the most that any task ever held."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def tidy(run):
    """A function for ``mapInArrow`` that gives memory back when its task is over: several workers
    of an executor wait for tasks of later stages, and each would keep its last batch."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return whole


def _libc():
    try:
        library = ctypes.CDLL("libc.so.6")
        return library if hasattr(library, "malloc_trim") else None
    except OSError:  # another C library
        return None


_LIBC = _libc()


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word (A-Z lower-cased) and the index of its row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~separator[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    prefix = prefix_hash(data, _BYTE_LOWER)
    return range_hash(prefix, start, end), np.searchsorted(offsets, start, side="right") - 1


_GRAM = _keys(8, 77)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles.  A row of
    1 to k-1 words has one, of its whole sequence; a row without words none."""
    hashes, row = words(data, offsets)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    ends = np.cumsum(counts)
    grams = np.zeros(max(len(hashes) - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        grams += hashes[i: i + len(grams)] * _GRAM[i]
    grams = mix(grams)
    out = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= k:
            out.append(np.unique(grams[end - n: end - k + 1]))
        elif n:
            out.append(mix((hashes[end - n: end] * _GRAM[:n]).sum(keepdims=True) + _U(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def stage(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: later reads survive
    lost executors and lineage ends here.  With ``batch_bytes`` its functions get Arrow batches
    of about that size (a larger row alone): a batch is held on both sides of a worker's pipe."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(BATCH_BYTES) if batch_bytes else None
    try:
        if batch_bytes:
            spark.conf.set(BATCH_BYTES, str(batch_bytes))
        df.write.parquet(path)
    finally:
        if before:
            spark.conf.set(BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stage table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over the session's shuffle partitions (small hot stage inputs)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels may not be learnt from: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def let(value: Column, body) -> Column:
    """Name an expression so that it is computed once: the only element of a one-element array."""
    return F.get(F.transform(F.array(value), body), 0)
