"""A cleaning pipeline over ``documents``: each stage is written as Parquet and
read again as the next one's input, so a lost executor never costs more than the
running stage.

1. toxicity: documents that the model scores at 0.5 or more go.
2. near-duplicates: one document (the smallest id) of each component stays.
3. suffixes: every repeated 200-byte string goes from the texts; bytes of a
   character that is cut in two go too.  Documents stay, also with an empty text.
4. decontamination: documents that hold a benchmark item go.
5. tokens: the remaining texts as token ids, with the length of the decoded text.

Defined cases are those of the operators; rows with a null ``doc_id`` are judged
like others but never linked; a null text counts as empty.  ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm import bpe, decontaminate, neardup, suffixes, toxicity
from citytherm.llm.common import stage, table

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the toxicity model scores under 0.5."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, DOCUMENT_COLUMNS)
    return scored.where(F.col("score") < 0.5).select(DOCUMENT_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component, one row of each id:
    the one whose text has the smallest hash, then the smallest row."""
    keep = neardup.classes(docs).where("doc_id = component_id").select("doc_id").distinct()
    ids = docs.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("k")).first()
    known = docs.join(keep, "doc_id", "left_semi")
    if ids["n"] != ids["k"]:
        rest = [c for c in DOCUMENT_COLUMNS if c != "doc_id"]
        known = known.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), *rest)).alias("r")).select("doc_id", *[f"r.{c}" for c in rest])
    return known.unionByName(docs.where("doc_id IS NULL")).select(DOCUMENT_COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeated strings cover."""
    out = suffixes.deduplicate(docs, [c for c in DOCUMENT_COLUMNS if c not in ("text", "n_chars")], as_text=True)
    return out.withColumn("text", F.col("kept")).withColumn("n_chars", F.char_length("text").cast("long")).select(DOCUMENT_COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, decoded_chars of every remaining text."""
    carried = ["doc_id", "lang", "source"]
    encoded = bpe.encode(docs, carried)
    decoded = bpe.decode(encoded, [*carried, "ids"])
    return decoded.select(*carried, "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.char_length(F.decode("bytes", "UTF-8")).cast("long").alias("decoded_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffixes", cut_repeats),
    ("decontamination", drop_contaminated),
    ("tokens", tokens),
]

#: Model scores and tokenisation are not expressible in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
