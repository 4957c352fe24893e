"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct words, word pairs and skip-grams (two words
with one between), hashed to ``2**bits`` coordinates.  Words are runs of letters
and digits, A-Z lower-cased.  Training keeps FTRL's two numbers per coordinate;
the per-coordinate rate and the L1 term leave most weights at exactly zero, so
the model is a short list of (coordinate, weight).

Training takes at most ``sample_rows`` labelled rows (those with the smallest
hash of the id), dealt over ``shards`` tasks.  Each shard runs FTRL on its rows
in id order, and the shard models are averaged coordinate by coordinate in a
grouped sum: no shard needs another one, and a lost executor repeats its shard
with the same result.  Scoring is one map over the whole texts.

Defined cases: null and empty texts have the score of the bias alone; rows with
a null id or null label do not train; several labels of one id count as the
largest; with no labelled rows, or one class only, the model is the bias ``-4`` alone and predicts
0 everywhere; repeated rows are scored each; other columns of the input are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import _U, give_back, held_out, mix, slices, table, tidy, words

_NOT_WORD = np.ones(256, dtype=bool)
_NOT_WORD[128:] = False
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    _NOT_WORD[_lo:_hi] = False


@dataclass(frozen=True)
class Settings:
    bits: int = 22
    sample_rows: int = 24_000  # bound on the labelled rows that train
    shards: int = 2
    epochs: int = 4
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.01


@dataclass(frozen=True)
class Model:
    bits: int
    bias: float
    index: np.ndarray  # at most 2**bits entries, so the model's size is bounded
    weight: np.ndarray


NO_MODEL_BIAS = -4.0


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all n-grams of a slice and their rows (with repeats)."""
    h, row = words(data, offsets, _NOT_WORD)
    parts, rows = [h], [row]
    for gap, seed in ((1, 0x1F83D9ABFB41BD6B), (2, 0x5BE0CD19137E2179)):
        if len(h) > gap:
            same = row[gap:] == row[:-gap]
            parts.append(mix(h[:-gap] * _U(seed) + h[gap:])[same])
            rows.append(row[gap:][same])
    return (np.concatenate(parts) >> _U(64 - bits)).astype(np.int64), np.concatenate(rows)


def distinct(index: np.ndarray, row: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((row << bits) | index)
    return key & ((1 << bits) - 1), key >> bits


class Ftrl:
    """One shard's learner.  Coordinate ``2**bits`` is the bias, without L1."""

    def __init__(self, s: Settings):
        self.s = s
        self.z = np.zeros((1 << s.bits) + 1)
        self.n = np.zeros((1 << s.bits) + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, s = self.z[i], self.s
        l1 = np.where(i == (1 << s.bits), 0.0, s.l1)
        rate = (s.beta + np.sqrt(self.n[i])) / s.alpha + s.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / rate)

    def learn(self, i: np.ndarray, label: int) -> None:
        i = np.append(i, 1 << self.s.bits)
        w = self.weights(i)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[i] = n + g * g


def _train_shard(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as kept:  # the task's own, gone with it: epochs read it row by row
            sizes: list[int] = []
            labels: list[int] = []
            for batch in batches:
                for part, data, offsets in slices(batch, "text"):
                    index, row = distinct(*features(data, offsets, s.bits), s.bits)
                    sizes += np.bincount(row, minlength=part.num_rows).tolist()
                    labels += part.column("label").to_pylist()
                    kept.write(index.astype(np.int32).tobytes())
            if not labels:
                return
            learner = Ftrl(s)
            for _ in range(s.epochs):
                kept.seek(0)
                for n, y in zip(sizes, labels):
                    learner.learn(np.frombuffer(kept.read(4 * n), np.int32).astype(np.int64), y)
        at = np.append(np.flatnonzero(learner.n[:-1]), 1 << s.bits)
        w = learner.weights(at)
        keep = (w != 0) | (at == 1 << s.bits)
        yield pa.RecordBatch.from_arrays([pa.array(at[keep]), pa.array(w[keep])], ["index", "weight"])
        del learner, w, at, keep
        give_back()
    return run


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> Model:
    """Train on labelled rows outside the held-out fold."""
    s = settings
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample_rows))
    classes = rows.agg(F.min("label").alias("a"), F.max("label").alias("b")).first()
    if classes["a"] == classes["b"]:  # nothing to tell apart
        return Model(s.bits, NO_MODEL_BIAS, np.zeros(0, np.int64), np.zeros(0))
    texts = documents.select("doc_id", "text")
    # the sample is at most sample_rows pairs of numbers: a bounded broadcast
    sample = texts.join(F.broadcast(rows), "doc_id")
    shards = (sample.repartition(s.shards, F.pmod(F.xxhash64("doc_id"), F.lit(s.shards)))
              .sortWithinPartitions("doc_id", "text").select("text", "label"))
    found = (shards.mapInArrow(tidy(_train_shard(s)), "index long, weight double")
             .groupBy("index").agg(F.sum("weight").alias("total"), F.count("*").alias("n")).collect())
    shards_used = max([r["n"] for r in found if r["index"] == 1 << s.bits], default=0)
    if not shards_used:
        return Model(s.bits, NO_MODEL_BIAS, np.zeros(0, np.int64), np.zeros(0))
    found.sort(key=lambda r: r["index"])
    return Model(s.bits, found[-1]["total"] / shards_used,
                 np.array([r["index"] for r in found[:-1]], dtype=np.int64),
                 np.array([r["total"] / shards_used for r in found[:-1]]))


def score(documents: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """The given columns of ``documents`` with ``score``, in one map over whole texts."""
    columns = columns or ["doc_id"]
    known = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        dense = np.zeros(1 << m.bits, dtype=np.float32)
        dense[m.index] = m.weight
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                index, row = features(data, offsets, m.bits)
                hit = dense[index] != 0
                index, row = distinct(index[hit], row[hit], m.bits)
                logit = m.bias + np.bincount(row, weights=dense[index], minlength=part.num_rows)
                probability = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in columns] + [pa.array(probability)],
                    [*columns, "score"])

    wanted = documents.select(*dict.fromkeys([*columns, "text"]))
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    return wanted.mapInArrow(tidy(run), f"{kinds}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every text; labels come from the training fold only."""
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"))
    return (score(documents, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
