import tracemalloc
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citytherm.llm import tokenfiles as t
from citytherm.llm.wordcodes import Encoder, Vocabulary


SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = t.op11_token_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected(rows))


def test_nulls_repeats_long_texts_and_many_shards(spark, docs_of):
    long = "abc def, " * 40_000
    rows = [(3, "b a"), (None, "x"), (1, None), (2, ""), (3, "b a"), (5, long), (4, "<|endoftext|> É́　ß"), (6, "\n \t")]
    docs = docs_of(rows)
    shards = t.write(docs, t.Settings(shard_tokens=4, least=2))
    got = t.read(shards).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(order)
    places = t.read(shards)
    ids = {(r.doc_id, tuple(r.ids)) for r in t.lookup(shards, places.where("doc_id IS NULL OR doc_id > 3")).collect()}
    assert ids == {(i, tuple([*LIBRARY.encode(x or "", add_special_tokens=False).ids, 2])) for i, x in rows if i is None or i > 3}


def test_empty_table(spark, docs_of):
    assert t.read(t.write(docs_of([]))).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(0, 400), st.integers(0, 100))
def test_grammar_round_trip_and_random_access(ids, start, count):
    s = t.Settings(terminals=6, least=2, gain=0)
    ids = np.array(ids, np.int32)
    rules, lengths, symbols = t.compress(ids, s)
    payload = t.pack(rules, lengths, symbols, s.terminals)
    assert t.expand(payload).tolist() == ids.tolist()
    assert t.expand(payload, start, count).tolist() == ids[start: start + count].tolist()
    # a pair that still occurs more than once without overlap is one that no round could take
    assert len(symbols) <= len(ids)


def test_compression_follows_repeats():
    ids = np.tile(np.arange(64, dtype=np.int32), 1000)
    rules, lengths, symbols = t.compress(ids)
    assert len(symbols) < 100 and lengths.max() >= 64


@pytest.mark.parametrize("v", [Vocabulary("word_bpe_49k.json", blank=True), Vocabulary("byte_bpe_50k.json", plain_specials=True), Vocabulary("byte_bpe_50k.json")])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=list(" \t\n 　\u0085\x1caAbz'śÉ12.,!:<|>好Σ")) | st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|> a", "a  b", "x\n\ny"]), max_size=6))
def test_pieces_give_the_library_ids(v, texts):
    encoder = Encoder.of(v)
    raw = [x.encode() for x in texts]
    ends = np.cumsum([0, *map(len, raw)])
    ids, rows = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), ends)
    want = [encoder.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert [ids[a:b].tolist() for a, b in zip(rows, rows[1:])] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=list(" \t\n 　\u0085\x1c\0aAbz'é12.,▁<|>好🙂")) | st.sampled_from(["<s> a", "a  b ", " x\n\ny ", "<0x0A>"]), max_size=6))
def test_word_pieces_give_the_library_ids(texts):
    encoder = Encoder.of(Vocabulary("piece_bpe_32k.model"))
    raw = [(" " + x).encode() for x in texts]
    ids, rows = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [ids[a:b].tolist() for a, b in zip(rows, rows[1:])] == [encoder.tokenizer.encode(x) for x in texts]


def test_a_worker_holds_little_beside_a_batch(monkeypatch):
    monkeypatch.setattr(t.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 0))
    words = np.random.default_rng(1).integers(0, 3000, (6000, 350))
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(words)), "text": [" ".join(f"w{i}" for i in row) for row in words]})  # 11 MB of text
    Encoder.of(t.Settings().vocabulary)
    tracemalloc.start()
    try:
        assert sum(len(shard.column("doc_ids")[0]) for shard in t._write(t.Settings())(iter([batch]))) == len(words)
        assert tracemalloc.get_traced_memory()[1] < 100 << 20  # 67 MB; 174 MB when all ids of 8 MB were placed at once
    finally:
        tracemalloc.stop()


def test_short_pieces_share_library_calls():
    """Distinct words go many to a call, and their ids are those of the library alone."""
    import random
    rng = random.Random(7)
    odd = ["\x01", "a\x01b", "<|endoftext|>", "x<|y", "</w>", "é", "́z", "don't", "'s", "1a2", "é", "中文", "K", "&&", "a,b", "\x00", "ab cd", "z" * 60]
    texts = [" ".join(rng.choice(odd) if rng.random() < 0.1 else "".join(rng.choice("abcdeZé&") for _ in range(rng.randint(1, 9)))
                      for _ in range(30)) for _ in range(200)] + odd + ["", "\n"]
    encoder = Encoder(Vocabulary("word_bpe_49k.json", blank=True))
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return LIBRARY.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, ends = encoder.encode(data, offsets)
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
    plain = [i for i, t in enumerate(texts) if "<|" not in t and "\x01" not in t]
    sent.clear()
    encoder._clear()
    part = [texts[i] for i in plain]
    encoder.encode(np.frombuffer("".join(part).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in part)]))
    assert len(encoder.table) > 2000 and len(sent) < len(encoder.table) / 30
