import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from citytherm.llm import suffixes as S


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k: k + S.WIDTH] for _, b in texts for k in range(len(b) - S.WIDTH + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - S.WIDTH + 1):
            if seen[b[k: k + S.WIDTH]] > 1:
                gone[k: k + S.WIDTH] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def cases(corpus):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (50, 60, 90, 400)]
    rows = list(corpus) + [(400, "ab" * 400), (401, "z" * 260), (402, "z" * 199), (403, "ab" * 100)]
    for i in range(60):
        t = text(rng.randint(1, 200))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            t += rng.choice(" xyé") + p[a: a + rng.randint(150, 700)] + rng.choice("12 ") + text(rng.randint(1, 60))
        rows.append((500 + i, t))
    return rows


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in S.deduplicate(df, ["doc_id"]).collect()), key=str)


@pytest.mark.parametrize("split", [256, 2])
def test_matches_brute_force(spark, docs_of, corpus, monkeypatch, split):
    monkeypatch.setattr(S, "SPLIT", split)
    rows = cases(corpus)  # repeated ids: rows get numbers
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 40
    assert got(docs_of(rows)) == want


def test_unique_ids_and_pieces(spark, docs_of, corpus, monkeypatch):
    rows = [(i, t) for i, (_, t) in enumerate(cases(corpus)[20:])]
    assert got(docs_of(rows)) == brute(rows)


def test_runs_do_not_depend_on_pieces(corpus, monkeypatch):
    texts = [(t or "").encode() for _, t in cases(corpus)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def windows():
        return {(r, s + j): (p, h) for part in S.runs(data, offsets) for r, s, n, p, h in zip(*(x.tolist() for x in part)) for j in range(n)}
    whole = windows()
    monkeypatch.setattr(S, "PIECE", 1000)
    assert windows() == whole
    assert len(whole) == sum(max(len(t) - S.WIDTH + 1, 0) for t in texts)


def test_merge_equals_sorting(corpus):
    """Common prefixes from the transforms equal those of all suffixes sorted together."""
    rng = random.Random(1)
    strings = [["".join(rng.choice("ab") for _ in range(n)) for n in sizes] for sizes in ((50, 7), (80,), (300, 1, 90))]
    made = [S.transform(np.frombuffer(b"".join(x.encode() + b"\xff" for x in own), np.uint8)) for own in strings]
    got = S.merge(made, 12).tolist()
    suffixes = [x[i:] for own in strings for x in own for i in range(len(x) + 1)]
    share = lambda x, y: next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    order = sorted(range(len(suffixes)), key=lambda i: suffixes[i])
    want = [0] * len(order)
    for a, b in zip(order, order[1:]):
        d = min(share(suffixes[a], suffixes[b]), 12) // 2 * 2
        want[a], want[b] = max(want[a], d), max(want[b], d)
    assert got == want


def test_empty_table(spark, docs_of):
    assert S.deduplicate(docs_of([]), ["doc_id"]).count() == 0


def test_merge_from_window_ends_finds_the_same_repeats(corpus):
    """Started only where a whole window ends, the merge tells the windows apart as before."""
    rng = random.Random(2)
    strings = [["".join(rng.choice("ab") for _ in range(n)) for n in sizes] for sizes in ((50, 12), (80,), (300, 1, 90))]
    made = [S.transform(np.frombuffer(b"".join(x.encode() + b"\xff" for x in own), np.uint8)) for own in strings]
    ends = np.concatenate([np.arange(len(x) + 1) >= 12 for own in strings for x in own])
    found = S.merge(made, 12, ends) >= 12
    assert found.tolist() == (S.merge(made, 12) >= 12).tolist()
    windows = [x[i: i + 12] if i + 12 <= len(x) else None for own in strings for x in own for i in range(len(x) + 1)]
    seen = Counter(windows)
    assert found.tolist() == [w is not None and seen[w] > 1 for w in windows]
