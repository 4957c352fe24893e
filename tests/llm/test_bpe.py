import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from citytherm.llm import bpe


def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(rows):
    enc, out = reference(), []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_library(spark, docs_of, corpus):
    odd = [(300, "don't  stop\n\n  now 12345 x²½ 日本語 🙂🙂 a\u00a0b <|endoftext|>"), (301, "x" * 5000), (302, " " * 3000 + "end"), (None, "null id"), (303, "it's we'll 's 'll" * 300), (304, "\n\nb a  c" * 400),
           (305, "".join(random.Random(1).choice(list(" \n\t ab'é1,.")) for _ in range(9000)))]
    rows = corpus + odd
    for s in (bpe.Settings(), bpe.Settings(chunk=700, overlap=40), bpe.Settings(chunk=64, overlap=8, cached_pieces=10)):
        assert sorted(map(tuple, bpe.digests(docs_of(rows), s).collect()), key=str) == expected(rows)


def test_empty_table(spark, docs_of):
    assert bpe.digests(docs_of([])).count() == 0


def test_tasks_give_memory_back():
    """After a task a worker keeps no table of powers; decoding needs the ranks alone."""
    import pyarrow as pa
    from citytherm.llm import common, suffixes, wordcodes
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["x y " * 900, "é" * 400])], ["rid", "text"])
    found = list(common.tidy(suffixes._emit_anchors)(iter([batch])))
    assert sum(b.num_rows for b in found) > 0 and not common._POWERS
    common.powers(1000)
    assert len(common._POWERS["up"]) <= 1 << 16  # as large as the texts need
    common.give_back()
    assert not common._POWERS
    held = set(wordcodes.Encoder.held)
    decoder = bpe.Decoder.of(bpe.Settings(chunk=1 << 14))  # settings of this test alone
    text = "na\u00efve  text,\n\u4e2d"
    ids = np.array(reference().encode_ordinary(text))
    assert bytes(decoder.bytes(ids)[0]).decode() == text
    assert set(wordcodes.Encoder.held) == held
