import hashlib

import duckdb
from pyspark.sql import functions as F

from citytherm.llm import chat

ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|> & &lt; b"), (1, 2, "assistant", None), (1, 3, "assistant", "x<|and|>y"), (1, 4, "user", ""),
        (2, None, None, "no role"), (2, 5, "sys|>tem\n", "é🙂"), (2, 5, "sys|>tem\n", "é🙂"), (2, 5, "assistant", "tie"),
        (3, 0, "assistant", "only"), (None, 1, "user", "no id"), (4, 0, "", "")]


def test_round_trip_and_mask(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.format_chat(df).withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    for conv in {r[0] for r in ROWS}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [x[2:] for x in turns]
        out = got[conv]["formatted"]
        loss = [out[s["start"]: s["start"] + s["length"]].replace("&gt;", ">").replace("&lt;", "<").replace("&amp;", "&") for s in got[conv]["loss_spans"]]
        assert loss == [x[3] for x in turns if x[2] == "assistant"]
    assert got[1]["formatted"].count("<|assistant|>") == 1  # adjacent turns merged


def test_query_matches_sql_and_hash(spark, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([r for r in ROWS if r[0] is not None], "conv_id long, turn long, role string, text string").write.parquet(path)
    got = chat.op5_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.execute(chat.OP5_SQL).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    odd = got.where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert odd["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert odd["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and odd["loss_chars"] == len(said)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert [r["conv_id"] for r in chat.op5_chat_format(spark, str(tmp_path)).collect()] == [-1]


def test_a_conversation_of_50000_turns(spark):
    import time
    turns = [(9, i, "assistant" if i % 3 else "user", f"é <{i}> & 🙂 " + "x" * (i % 40)) for i in range(50_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    begin = time.time()
    out = chat.format_chat(df).select("formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"),
                                      chat.spanned(F.col("formatted"), F.col("loss_spans")).alias("cut")).first()
    assert time.time() - begin < 60
    assert [(t["role"], t["text"]) for t in out["turns"]] == [x[2:] for x in turns]
    said = [x[3] for x in turns if x[2] == "assistant"]
    plain = lambda x: x.replace("&gt;", ">").replace("&lt;", "<").replace("&amp;", "&")
    assert [plain(x) for x in out["cut"]] == said
    assert [plain(out["formatted"][s["start"]: s["start"] + s["length"]]) for s in out["loss_spans"]] == said


def test_messages_merge_adjacent_roles(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [(m["role"], m["texts"]) for m in r["messages"]] for r in chat.messages(df).collect()}
    assert got[1] == [("user", ["hi"]), ("assistant", ["a <|end|> & &lt; b", "", "x<|and|>y"]), ("user", [""])] and got[4] == [("", [""])]
