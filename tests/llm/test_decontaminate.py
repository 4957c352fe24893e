import random

from citytherm.llm import decontaminate as D


def brute(docs, items):
    out = []
    for d, t in docs:
        have = D.shingle_tuples(t or "")
        for i, x in items:
            want = D.shingle_tuples(x or "")
            if want and 100 * len(want & have) >= 75 * len(want):
                out.append((d, i, len(want), len(want & have)))
    return sorted(out)


def cases(corpus):
    rng = random.Random(1)
    items = [(1, None), (2, "  "), (3, "one"), (4, "a b c"), (5, "A B c d e")]
    docs = list(corpus)
    for k in range(40):
        words = [f"q{rng.randrange(5000)}" for _ in range(rng.choice((5, 8, 40, 300)))]
        items.append((10 + k, " ".join(words)))
        cut = rng.uniform(0.6, 1.0)
        part = words[: int(len(words) * cut)]
        docs.append((200 + k, f"{corpus[8][1][:rng.randrange(30000)]} {' '.join(part)} tail {' '.join(words[-5:])}"))
    return docs, items + [items[-1]]


def test_matches_brute_force(spark, docs_of, corpus):
    docs, items = cases(corpus)
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id long")
    want = brute(docs, items)
    assert len(want) > 20
    assert sorted(map(tuple, D.search(docs_of(docs), bench).collect())) == want
    blocks = D.Settings(block_bytes=2000)  # many blocks of items
    assert sorted(map(tuple, D.search(docs_of(docs), bench, blocks).collect())) == want


def test_empty_tables(spark, docs_of, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.search(docs_of(corpus), none).count() == 0
    assert D.search(docs_of([]), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0
