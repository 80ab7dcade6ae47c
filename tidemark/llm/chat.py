"""Chat formatting of typed content parts.

A turn is a role and an array of parts (text, image, audio, document). A fold
visits the parts in order: text is escaped and appended, anything else leaves an
ordered placeholder, its reference and how many tokens it expands to. The fold
runs before any shuffle, and a turn's text is shuffled once. Only turns of long
conversations (of more than ``LONG`` turns, and so many that at most ``MOST`` are
long) are first joined in blocks of ``BLOCK`` turn numbers, so that a hot
conversation is pre-aggregated in many tasks before it becomes the one string
that it has to be.

The template marks turns with ``<|turn|>role<|says|>content<|end|>``. Control
strings inside roles and texts (its own and those of common templates) get a
``~`` after their first character, and one more if they have some already, so
escaping is reversible and no marker can be forged. The loss mask is a list of
(start, length) spans in code points for each turn, over assistant text only.

Cases: null text is empty, a null role is empty; turns are ordered by turn,
role, text with nulls first, which also settles ties; repeated rows are turns of
their own; a null conv_id is one conversation; an unknown part type is text; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import let, table
from tidemark.session import materialize

QUERY = "op1_chat_format"
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"
BLOCK, LONG, MOST = 64, 1_024, 100_000

#: Tokens: an image patch's side, audio tokens a second, tokens a document page.
PATCH, AUDIO_RATE, PAGE = 14, 25, 512

#: After ``<`` or ``[``: what makes a control string.
_TAIL = r"(\||/?s>|/?INST\]|/?SYS>)"

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(~*)" + _TAIL, r"$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])~(~*)" + _TAIL, r"$1$2$3")


def _tokens(p: Column) -> Column:
    sides = F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)
    count = (
        F.when(p["type"] == "image", sides)
        .when(p["type"] == "audio", F.ceil(p["seconds"] * AUDIO_RATE))
        .when(p["type"] == "document", p["pages"] * PAGE)
    )
    return F.coalesce(count, F.lit(0)).cast("long")


def _visit(parts: Column, trained: Column) -> Column:
    """struct(body, spans, attachments) of the parts of a turn, in order."""
    spans = "array<struct<start:long,length:long>>"
    refs = "array<struct<ordinal:int,type:string,ref:string,tokens:long>>"
    start = F.struct(
        F.lit("").alias("body"), F.array().cast(spans).alias("spans"), F.array().cast(refs).alias("attachments")
    )

    def step(acc: Column, p: Column) -> Column:
        text = escape(F.coalesce(p["text"], F.lit("")))
        span = F.struct(F.char_length(acc["body"]).cast("long").alias("start"), F.char_length(text).cast("long").alias("length"))
        ref = F.struct(
            F.size(acc["attachments"]).alias("ordinal"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")
        )
        other = F.coalesce(p["type"].isin("image", "audio", "document"), F.lit(False))
        return F.struct(
            F.concat(acc["body"], F.when(other, F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(text)).alias("body"),
            F.when(other | ~trained, acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span)).cast(spans)).alias("spans"),
            F.when(other, F.concat(acc["attachments"], F.array(ref)).cast(refs)).otherwise(acc["attachments"]).alias("attachments"),
        )

    return F.aggregate(parts, start, step)


def _said(body: Column) -> Column:
    """The text of a turn's body, as it was."""
    return unescape(F.regexp_replace(body, r"<\|(image|audio|document)\|>", ""))


def _in_order(turns: Column) -> Column:
    """Turns by number, role and text. Texts are only read back where numbers and
    roles are not enough."""
    told_apart = F.size(F.array_distinct(F.transform(turns, lambda t: F.struct(t["turn"], t["role"])))) == F.size(turns)

    def body(t: Column) -> Column:
        return F.substr(t["segment"], t["head"] + 1, F.char_length(t["segment"]) - t["head"] - len(END))

    keyed = F.transform(turns, lambda t: F.struct(t["turn"].alias("a"), t["role"].alias("b"), _said(body(t)).alias("c"), t.alias("t")))
    by_text = F.transform(F.sort_array(keyed), lambda k: k["t"])
    return F.when(told_apart, F.sort_array(turns)).otherwise(by_text)


def _joined(turns: DataFrame, *keys: str) -> DataFrame:
    """(keys, text, spans, attachments) of all turns with the same keys."""
    return (
        turns.groupBy(*keys)
        .agg(F.collect_list("t").alias("t"))
        .select(*keys, _in_order(F.col("t")).alias("t"))
        .select(
            *keys,
            F.array_join("t.segment", "").alias("text"),
            F.col("t.spans").alias("spans"),
            F.flatten("t.attachments").alias("attachments"),
        )
    )


def _long(turns: DataFrame) -> DataFrame:
    """(long_id) of long conversations: at most ``MOST`` rows."""
    total = turns.count()
    return materialize(
        turns.groupBy(F.col("conv_id").alias("long_id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(LONG, total // MOST)).select("long_id"),
        "op1-long",
    )


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """From (conv_id, turn, role, parts): conv_id, formatted, loss_mask (a list
    of spans for each turn, counted from the turn's start), attachments in order
    and the tokens that they expand to."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    head = F.concat(F.lit(TURN), escape(role), F.lit(SAYS))
    visited = turns.select(
        "conv_id",
        "turn",
        F.col("role").cast("string").alias("role"),
        head.alias("head"),
        _visit(F.coalesce(F.col("parts"), F.array().cast(PARTS)), role == loss_role).alias("v"),
    )
    turn = F.struct(
        "turn",
        "role",
        F.char_length("head").alias("head"),
        F.concat("head", "v.body", F.lit(END)).alias("segment"),
        F.transform(
            "v.spans",
            lambda s: F.struct((s["start"] + F.char_length("head")).alias("start"), s["length"].alias("length")),
        ).alias("spans"),
        F.col("v.attachments").alias("attachments"),
    )
    each = visited.select("conv_id", turn.alias("t"))
    long_ids = F.broadcast(_long(turns))
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    whole = _joined(each.join(long_ids, same, "left_anti"), "conv_id")
    cut = each.join(long_ids, same, "left_semi").withColumn("block", F.floor(F.col("t.turn") / BLOCK))
    blocks = _joined(cut, "conv_id", "block")
    long_ones = (
        blocks.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("block", "text", "spans", "attachments"))).alias("b"))
        .select(
            "conv_id",
            F.array_join("b.text", "").alias("text"),
            F.flatten("b.spans").alias("spans"),
            F.flatten("b.attachments").alias("attachments"),
        )
    )
    return (
        whole.unionByName(long_ones)
        .select("conv_id", F.col("text").alias("formatted"), F.col("spans").alias("loss_mask"), "attachments")
        .withColumn(
            "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
        )
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""

    def one(segment: Column) -> Column:
        halves = F.split(F.substring(segment, len(TURN) + 1, 1 << 30), r"<\|says\|>")
        return let(
            halves,
            lambda h: F.struct(
                unescape(F.get(h, 0)).alias("role"),
                _said(F.regexp_replace(F.get(h, 1), r"<\|end\|>\n$", "")).alias("text"),
            ),
        )

    return F.transform(_segments(formatted), one)


def _segments(formatted: Column) -> Column:
    return F.split(formatted, r"(?=<\|turn\|>)")


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    pieces = F.zip_with(
        _segments(formatted),
        mask,
        lambda segment, spans: F.array_join(
            F.transform(spans, lambda s: unescape(F.substr(segment, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
        ),
    )
    return F.array_join(pieces, "")


def text_turns(rows: DataFrame) -> DataFrame:
    """Plain (conv_id, turn, role, text) rows as turns of one text part."""
    null = {k: F.lit(None).cast(t).alias(k) for k, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))}
    part = F.struct(F.lit("text").alias("type"), F.col("text").cast("string").alias("text"), *null.values())
    return rows.select("conv_id", "turn", "role", F.array(part).cast(PARTS).alias("parts"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.explode(F.array(F.lit("user"), F.lit("assistant"))).alias("role")
    planted = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), roles, F.lit(said).alias("text"))
    planted = planted.withColumn("turn", (F.col("role") == "assistant").cast("long"))
    done = format_chats(text_turns(rows.unionByName(planted)))
    read = done.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


_ESCAPED = r"regexp_replace({}, '([<\[])(~*)(\||/?s>|/?INST\]|/?SYS>)', '\1~\2\3', 'g')"
ORACLE_SQL = f"""
with c as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
r as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as i,
             coalesce(role, '') as role, coalesce(text, '') as text from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {len(TURN + SAYS + END)})::bigint as formatted_chars
from r group by conv_id
"""
