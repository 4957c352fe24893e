import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, registers string, node long, key string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from citytherm.session import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of documents from (doc_id, text), with extra columns of clashing names."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "x", 7, "k") for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, ties, nulls, blanks and a long text."""
    rng = random.Random(5)
    vocabulary = ["w" + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "One"), (5, "a b c"), (6, "a b c d e"), (7, "A b  c\td e"), (8, text(6000))]
    base = text(120)
    rows += [(10, base), (11, base), (12, base.upper()), (20, "é ü \u2028 ü ß " + text(30))]
    for i in range(13, 20):  # near copies
        w = base.split()
        for _ in range(rng.randint(1, 7)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    chain = text(100).split()
    for i in range(30, 45):  # each near to the next only
        rows.append((i, " ".join(chain)))
        at = rng.randrange(80)
        chain = chain[:at] + text(6).split() + chain[at + 6:]
    rows += [(i, text(rng.randint(1, 60))) for i in range(50, 90)]
    return rows + [(10, base), (51, rows[-1][1])]
