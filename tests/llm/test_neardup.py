import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citytherm.llm import neardup
from citytherm.llm.components import components
from citytherm.llm.decontaminate import shingle_tuples


def brute(rows):
    sets = [(i, shingle_tuples(t or "")) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted((i, len(s), root(i)) for i, s in sets)


def test_matches_brute_force(spark, docs_of, corpus):
    got = neardup.classes(docs_of(corpus)).collect()
    assert sorted(map(tuple, got)) == brute(corpus)


def test_many_copies_and_pivot_rounds(spark, docs_of):
    """A large group of near copies, searched by pivots before anything is listed in full."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        w[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(w)))
    for s in (neardup.Settings(), neardup.Settings(block=7, pivot_rounds=2), neardup.Settings(pivot_rounds=0)):
        assert sorted(map(tuple, neardup.classes(docs_of(rows), s).collect())) == brute(rows)


def test_null_ids_and_empty_table(spark, docs_of):
    got = neardup.classes(docs_of([(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in got) == [(-1, -1), (-1, -1), (5, 5)]
    assert neardup.classes(docs_of([])).count() == 0


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(1)
    s = neardup.Settings()
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 200))
    x, y = np.concatenate((both, a)), np.concatenate((both, b))
    u, v, joined = neardup.sketch([x, y, np.unique(np.concatenate((x, y)))], s)
    assert (np.maximum(u, v) == joined).all()
    j = neardup.estimate(u[None], v[None], np.array([700]), np.array([800]), s)[0]
    assert abs(j - 600 / 900) < 0.12


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (5, 4), (9, 1)], [(i, i + 1) for i in range(40)], [(100, i) for i in range(30)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for u, v in edges:
            parent[u] = parent[v] = min(parent[u], parent[v])
    assert got == parent


def test_an_id_under_several_texts_is_linked_whatever_the_order(spark, docs_of):
    a = " ".join(f"w{i}" for i in range(41))
    b = " ".join(f"v{i}" for i in range(41))
    rows = [(1, a), (2, b), (2, a + " more"), (2, b), (3, b + " end"), (9, "far away from all of them")]
    want = None
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        for parts in (1, 3):
            got = sorted(map(tuple, neardup.classes(docs_of(order).repartition(parts)).select("doc_id", "n_shingles", "component_id").collect()))
            want = want or got
            assert got == want
    assert {r[2] for r in want if r[0] in (1, 2, 3)} == {1}
