import hashlib

from citytherm.llm import fingerprint as P


def edited(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(order):
        after, q = order[(k + 1) % len(order)][1], len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits_and_likeness(spark, docs_of, corpus):
    rows = corpus + [(None, "first of all"), (301, "x" * 3000)]
    got = P.compare(docs_of(rows)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == edited(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[10]["fingerprint"] == by[11]["fingerprint"] and by[10]["near_next"] == 1.0
    assert by[8]["near_edited"] > 0.6 and by[8]["near_next"] == 0.0
    assert by[0]["fingerprint"] == "" and by[3]["fingerprint"] != ""


def test_anchors_are_closed_syncmers(spark, docs_of, corpus):
    """The same anchors from the definition, on Spark's own token hashes."""
    from pyspark.sql import functions as F
    df = docs_of(corpus).select("text", P.anchors(F.coalesce("text", F.lit(""))).alias("a"),
                                F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(P.TOKEN), F.lit(0)), lambda t: F.xxhash64(t)).alias("t"))
    df = df.withColumn("m", F.expr(f"transform(sequence(0, size(t) - 1), i -> xxhash64({', '.join(f'get(t, i + {j})' for j in range(P.S))}))"))
    df = df.withColumn("w", F.expr(f"transform(sequence(0, size(t) - 1), i -> cast(shiftright(xxhash64({', '.join(f'get(t, i + {j})' for j in range(P.K))}), 32) as int))"))
    for r in df.collect():
        inner, n = P.K - P.S + 1, len(r["t"])
        want = [r["w"][i] for i in range(n - P.K + 1) if min(r["m"][i: i + inner]) in (r["m"][i], r["m"][i + inner - 1])]
        assert r["a"] == want if want else len(r["a"]) == (n > 0)


def test_one_row_and_none(spark, docs_of):
    one = P.compare(docs_of([(5, "a b c d e f g h")])).first()
    assert one["near_next"] == 1.0
    assert P.compare(docs_of([])).count() == 0


def test_short_texts_and_text_without_spaces(spark, docs_of):
    """Three quarters of any text hold an anchor; one character more changes only the anchors around it."""
    import random
    from pyspark.sql import functions as F
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9)))
    rows = [(i, " ".join(word() for _ in range(1 + i % 10))) for i in range(120)] + [(200 + n, "".join(rng.choice("abcdefgh ") for _ in range(n))) for n in range(1, 70)]
    for r in P.compare(docs_of(rows)).collect():
        assert r["near_edited"] > 0 and r["fingerprint"], r
    text = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(2000))
    pair = docs_of([(1, text), (2, text[:5] + "字" + text[5:])])
    one, two = (r["a"] for r in pair.select("doc_id", P.at_level(F.col("text"), P.level(F.col("text"))).alias("a")).orderBy("doc_id").collect())
    assert len(set(one) & set(two)) > 0.97 * len(one)
    got = P.compare(pair).orderBy("doc_id").collect()
    assert got[0]["near_next"] > 0.97 and got[0]["near_edited"] > 0.7


def test_edited_form_is_read_as_if_alone(spark, docs_of, corpus):
    from pyspark.sql import functions as F
    rows = [(100 + i, t) for i, (_, t) in enumerate(corpus)] + [(i, "x y" * i) for i in range(1, 40)]
    order = [t or "" for _, t in sorted(rows)]
    made = {i: t[: len(t) - len(t) // 4] + after[: len(t) // 4] for (i, t), after in zip(((i, t or "") for i, t in sorted(rows)), order[1:] + order[:1])}
    alone = docs_of(sorted(made.items())).select("doc_id", P.text_of(P.at_level(F.col("text"), P.level(F.col("text")))).alias("f"))
    assert {r["doc_id"]: r["edited_fingerprint"] for r in P.compare(docs_of(rows)).collect()} == {r["doc_id"]: r["f"] for r in alone.collect()}
