import duckdb
import pytest

import corpus_pipeline
from citytherm.llm import toxicity
from citytherm.llm.common import table
from test_bpe import reference
from test_decontaminate import brute as leaks
from test_neardup import brute as near
from test_suffixes import brute as repeats

SF = "/root/testdata/sf0.001"


def chain(rows, items, rejected):
    """The stages after the model, by brute force, from (doc_id, text)."""
    rows = [r for r in rows if r[0] not in rejected]
    keep = {i for i, _, c in near(rows) if i == c}
    rows = [r for r in rows if r[0] in keep]
    rows = [(r[0], r[4].decode("utf-8", "ignore")) for r in repeats(rows)]
    bad = {d for d, *_ in leaks(rows, items)}
    enc = reference()
    return sorted((i, enc.encode_ordinary(t), len(t)) for i, t in rows if i not in bad)


def test_run_matches_brute_force(spark):
    got = sorted((r["doc_id"], list(r["ids"]), r["decoded_chars"]) for r in corpus_pipeline.run(spark, SF).collect())
    docs = table(spark, SF, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels"))).collect()
    rejected = {r["doc_id"] for r in scored if r["score"] >= 0.5}
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    assert got == chain(rows, items, rejected)


def test_stages_keep_columns_and_bear_odd_rows(spark, docs_of, corpus, tmp_path):
    docs_of(corpus + [(None, "null id a b c"), (None, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "null id a b c"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "tokens":
            assert docs.columns == corpus_pipeline.DOCUMENT_COLUMNS
    ids = [r["doc_id"] for r in docs.collect()]
    assert ids.count(None) == 1 and len(ids) == len(set(ids)) and 10 in ids and 11 not in ids


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_empty_documents(spark, docs_of, stage):
    name, function = corpus_pipeline.STAGES[stage]
    empty = docs_of([]).select(corpus_pipeline.DOCUMENT_COLUMNS)
    assert function(spark, empty, SF).count() == 0
