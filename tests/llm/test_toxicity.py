import random
import zlib

from citytherm.llm import toxicity


def test_learns_from_other_folds(spark, docs_of):
    rng = random.Random(2)
    bad = ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad) + ","
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]  # held-out labels must not matter
    label = lambda x: spark.createDataFrame(x, "doc_id long, quality int, toxic int")
    docs = docs_of(rows + [(None, "vile"), (700, None), (701, ""), (0, rows[0][1])])
    model = toxicity.fit(docs, label(labels + [(None, 1, 1), (5, 1, None), (5, 1, 1)]))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(model.index) < 60
    held = [(t, got[i]) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((s >= 0.5) == bool(t) for t, s in held) / len(held) > 0.97
    assert got[700] == got[701] < 0.5 <= got[None]
    again = toxicity.fit(docs, label(flipped))
    assert (again.index == toxicity.fit(docs, label(labels)).index).all()


def test_no_labels_and_empty(spark, docs_of, corpus):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(corpus), none)
    scores = [r["score"] for r in toxicity.score(docs_of(corpus), model).collect()]
    assert len(scores) == len(corpus) and max(scores) < 0.5
    assert toxicity.score(docs_of([]), model).count() == 0
