import math
import zlib

from pyspark.sql import functions as F

from citytherm.llm import quality


def test_matches_hand_computation(spark, docs_of, corpus):
    rows = [r for r in corpus if r[0] is not None] + [(400 + i, "!! ### $$$ JUNK " * 9) for i in range(30)]
    docs = docs_of(rows)
    labels = [(i, int(i < 400)) for i in sorted({r[0] for r in rows})]
    label = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {(r["doc_id"], r["evidence"]): r for r in quality.score(docs, label).collect()}
    bins = {(r["doc_id"], tuple(r["bins"])): (r["host"], r["path"]) for r in quality.binned(docs).collect()}
    s = quality.Settings()
    y = {i: q for i, q in labels if zlib.crc32(str(i).encode()) % 5}
    train = [(*k, *quality_site(r)) for r in quality.binned(docs).collect() for k in [(r["doc_id"], r["bins"])] if r["doc_id"] in y]
    count, total = {}, {}
    for i, b, _, _ in train:
        for m, v in enumerate(b):
            count.setdefault((m, v), [0, 0])[1 - y[i]] += 1
    for (m, _), (g, b) in count.items():
        t = total.setdefault(m, [0, 0, 0])
        t[0], t[1], t[2] = t[0] + g, t[1] + b, t[2] + 1
    weight = {k: s.damping * (math.log((g + 1) / (total[k[0]][0] + total[k[0]][2])) - math.log((b + 1) / (total[k[0]][1] + total[k[0]][2]))) for k, (g, b) in count.items()}
    want = {round(sum(weight.get((m, v), 0.0) for m, v in enumerate(b)), 9) for _, b in bins}
    assert {round(e, 9) for _, e in got} == want
    assert all(r["quality_score"] < 0.5 for (i, _), r in got.items() if i >= 400)
    assert sum(r["quality_score"] >= 0.5 for (i, _), r in got.items() if 50 <= i < 400) >= 39


def quality_site(r):
    return r["host"], r["path"]


def test_sparse_groups_shrink(spark):
    groups = spark.createDataFrame([("a", 1000, 900, 0.5), ("b", 1000, 100, 0.5), ("c", 1, 1, 0.5), ("d", 0, 0, 0.5)], "host string, n long, good long, prior double")
    got = {r["host"]: r["p"] for r in quality.posterior(groups.where("n > 0"), "prior", "p", quality.Settings()).collect()}
    assert got["a"] > 0.88 and got["b"] < 0.12 and 0.5 < got["c"] < 0.9


def test_nulls_no_labels_empty(spark, docs_of, corpus):
    docs = docs_of(corpus).withColumn("source", F.when(F.col("doc_id") > 5, F.col("source")))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(docs, none).where("quality_score is null").count() == 0
    assert quality.score(docs, none).count() == len(corpus)
    assert quality.score(docs_of([]), none).count() == 0
