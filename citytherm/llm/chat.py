"""Chat formatting with relational expressions only.

The turns of a conversation are collected as structs, sorted, adjacent turns of
one role are merged into one message by array aggregation, and the messages are
concatenated::

    <|user|>first text<|and|>second text of the same role<|end|><|assistant|>...<|end|>

Inside roles and texts ``&`` becomes ``&amp;``, ``<`` becomes ``&lt;``, and ``>``
becomes ``&gt;``, so no text can hold a control string, and reading back in the opposite order restores
every character.  ``<|and|>`` marks where merged turns meet, so the turns
themselves can be read back too.  The loss mask is a list of code point ranges of
the formatted string, one for each assistant turn.

The work of a conversation follows its own length: collecting its turns is what
formatting it means.  Conversations never meet each other.  Every array is named once and
read by place, lengths are added up in blocks, and spans are cut from chunks, so the work
grows with the turns and not with their square (50,000 turns in one conversation are tested).

Defined cases: null text and null role are empty; turns that tie on ``turn`` are
ordered by role, then text, and repeated rows stay (each is a turn); a null
``turn`` comes first; rows with a null ``conv_id`` form one conversation of their
own; other columns are ignored; an empty table gives only what is added to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import let, table

LEARN_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


_MESSAGE = "struct<role:string,texts:array<string>>"
BLOCK = 256     # turns whose lengths are added up one by one
CHUNK = 4096    # code points of the pieces from which spans are cut


def _turns(conversations: DataFrame) -> DataFrame:
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, messages: sorted turns, adjacent ones of one role merged."""
    def merged(turns: Column) -> Column:
        # positions where another role begins cut the sorted turns into messages
        starts = F.filter(F.sequence(F.lit(0), F.size(turns) - 1),
                          lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
        return let(starts, lambda at: F.transform(at, lambda a, i: F.struct(
            F.get(turns, a)["role"].alias("role"),
            F.transform(F.slice(turns, a + 1, F.coalesce(F.get(at, i + 1), F.size(turns)) - a), lambda x: x["text"]).alias("texts"))))
    return _turns(conversations).select("conv_id", let(F.col("turns"), merged).cast(f"array<{_MESSAGE}>").alias("messages"))


def _written(turns: Column, learn_role: str) -> Column:
    """array<struct<head, body, learn>>: what a turn adds to the formatted string.  A turn of
    the same role as the one before goes on in its message."""
    before = F.slice(F.concat(F.array(F.lit(None).cast("string")), F.transform(turns, lambda t: t["role"])), 1, F.size(turns))

    def entry(t: Column, role: Column) -> Column:
        opened = F.concat(F.when(role.isNull(), "").otherwise("<|end|>"), F.lit("<|"), escape(t["role"]), F.lit("|>"))
        return F.struct(F.when(role == t["role"], "<|and|>").otherwise(opened).alias("head"), escape(t["text"]).alias("body"),
                        (t["role"] == learn_role).alias("learn"))
    return F.zip_with(turns, before, entry)


def _begins(lengths: Column, body) -> Column:
    """``body(begin)`` with ``begin(i)``, the sum of the lengths before place ``i``:
    sums of whole blocks are added up once, the rest inside the block."""
    add = lambda acc, x: acc + x
    zero = F.lit(0).cast("long")
    total = lambda xs: F.aggregate(xs, zero, add)
    blocks = F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    base = let(sums, lambda own: F.transform(blocks, lambda b: total(F.slice(own, F.lit(1), b))))
    return let(base, lambda at: body(lambda i: F.get(at, F.floor(i / BLOCK).cast("int")) + total(F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))))


def format_chat(conversations: DataFrame, learn_role: str = LEARN_ROLE) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points, from 0)."""
    def spans(items: Column) -> Column:
        lengths = F.transform(items, lambda t: (F.char_length(t["head"]) + F.char_length(t["body"])).cast("long"))
        own = lambda begin: F.transform(F.filter(F.transform(items, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: x["t"]["learn"]), lambda x: F.struct(
            (begin(x["i"]) + F.char_length(x["t"]["head"])).alias("start"), F.char_length(x["t"]["body"]).alias("length")))
        return let(lengths, lambda n: _begins(n, own))

    def whole(items: Column) -> Column:
        return F.struct(F.concat(F.array_join(F.transform(items, lambda t: F.concat(t["head"], t["body"])), ""), F.lit("<|end|>")).alias("formatted"),
                        spans(items).alias("loss_spans"))
    made = let(F.col("turns"), lambda turns: let(_written(turns, learn_role), whole))
    return _turns(conversations).select("conv_id", made.alias("m")).select("conv_id", "m.formatted", "m.loss_spans")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def turns(p: Column) -> Column:
        # no escaped role holds a bracket, so the first "|>" ends the head
        role = F.substring_index(F.substr(p, F.lit(3)), "|>", 1)
        return let(role, lambda r: F.transform(F.split(F.substr(p, F.char_length(r) + 5), r"<\|and\|>"),
                                               lambda t: F.struct(unescape(r).alias("role"), unescape(t).alias("text"))))
    return F.flatten(F.transform(parts, turns))


def spanned(formatted: Column, spans: Column) -> Column:
    """array<string>: the code points of each span.  The string is cut into chunks
    once, so a span costs its own length and a chunk, not its distance from the start."""
    def cut(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.char_length(text) / CHUNK).cast("int")), lambda c: F.substring(text, c * CHUNK + 1, CHUNK))

    def one(chunks: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / CHUNK).cast("int"), F.floor((s["start"] + s["length"]) / CHUNK).cast("int")
        return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), (s["start"] % CHUNK + 1).cast("int"), s["length"])
    return let(let(formatted, cut), lambda chunks: F.transform(spans, lambda s: one(chunks, s)))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation, and one of control strings; digests are read back from the output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    lines = lambda turns: F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    turns = let(read_back(F.col("formatted")), lambda turns: F.struct(F.size(turns).cast("long").alias("n"), F.sha2(lines(turns), 256).alias("sha")))
    loss = let(F.array_join(F.transform(spanned(F.col("formatted"), F.col("loss_spans")), unescape), ""),
               lambda text: F.struct(F.char_length(text).cast("long").alias("n"), F.sha2(text, 256).alias("sha")))
    out = format_chat(given.unionByName(added))
    return out.select("conv_id", turns.alias("t"), loss.alias("l"), F.char_length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", F.col("t.n").alias("n_turns"), F.col("t.sha").alias("turns_sha256"),
        F.col("l.n").alias("loss_chars"), F.col("l.sha").alias("loss_sha256"), "formatted_chars")


def _sql_escape(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


OP5_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
     l AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM t
           WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
     f AS (SELECT *, CASE WHEN role = before THEN '<|and|>' ELSE CASE WHEN before IS NULL THEN '' ELSE '<|end|>' END
                          || '<|' || {_sql_escape('role')} || '|>' END || {_sql_escape('text')} AS piece FROM l)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(length(piece)) + 7)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
