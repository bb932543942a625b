"""Chat formatting with relational operations and expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one
role merge into one block by an array fold; blocks are concatenated as

    <s>ROLE[INST]TEXT[/INST]TEXT[/INST]</s>

Inside texts and roles a control string gets a backslash behind its bracket, and one
more if it has some already, so that no control string is left and one backslash less
gives the text back. ``parse`` reads conversations back from the formatted string.

Defined results: a null text is empty; a null role is the empty role; turns sort by
turn, then role, then text, null turns first, and repeated rows stay. A null conv_id is
a conversation. An empty table gives an empty result. Only the named columns are read.
A conversation is one row of the result, so its turns meet in one task, as its
formatted string must; conversations are spread by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template are <s> </s> [INST] [/INST].
_CONTROL = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\])"
_ESCAPED = r"([<\[])\\(\\*)(s>|/s>|INST\]|/INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


#: Fold the sorted turns into blocks of one role: the last block grows or a new one
#: begins. ``_starts`` are the places at which the role changes.
_STARTS = """filter(sequence(0, size(_turns) - 1), i ->
    i = 0 or get(_turns, i).role <> get(_turns, i - 1).role)"""
_BLOCKS = """transform(_starts, (s, k) -> struct(
    _turns[s].role as role,
    transform(slice(_turns, s + 1, coalesce(get(_starts, k + 1), size(_turns)) - s),
              t -> t.text) as texts))"""
#: The pieces of the formatted string, each with whether it is under the loss mask.
_PIECES = """flatten(transform(_blocks, b -> concat(
    array(struct(concat('<s>', b.role, '[INST]') as piece, false as loss)),
    flatten(transform(b.texts, t -> array(
        struct(t as piece, b.role = '{trained}' as loss),
        struct('[/INST]' as piece, false as loss)))),
    array(struct('</s>' as piece, false as loss)))))"""
_SPANS = """aggregate(_pieces,
    named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, length: bigint>>)),
    (a, p) -> named_struct('at', a.at + length(p.piece), 'spans', if(p.loss,
        concat(a.spans, array(named_struct('start', a.at, 'length', cast(length(p.piece) as bigint)))),
        a.spans)),
    a -> a.spans)"""


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text",
                         trained: str = "assistant") -> DataFrame:
    """conv_id, formatted, and the loss mask: spans of characters of ``formatted``.

    Each span covers the escaped text of one turn of the role ``trained``, no marks.
    """
    empty = F.lit("")
    turns = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            escape(F.coalesce(F.col(role), empty)).alias("role"),
            escape(F.coalesce(F.col(text), empty)).alias("text"),
        ).alias("_turn"),
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
        .withColumn("_starts", F.expr(_STARTS))
        .withColumn("_blocks", F.expr(_BLOCKS))
        .withColumn("_pieces", F.expr(_PIECES.format(trained=trained)))
        .select(
            "conv_id",
            F.array_join(F.transform("_pieces", lambda p: p["piece"]), "").alias("formatted"),
            F.expr(_SPANS).alias("loss_spans"),
        )
    )


def parse(formatted: DataFrame) -> DataFrame:
    """conv_id, its turns (role, text) as they were, and the text under the loss mask."""
    blocks = F.expr("slice(split(formatted, '</s>'), 1, size(split(formatted, '</s>')) - 1)")
    role = r"^<s>(?s)(.*?)\[INST\].*$"
    head = r"^<s>(?s).*?\[INST\]"
    parsed = formatted.withColumn("_parsed", F.transform(blocks, lambda b: F.struct(
        unescape(F.regexp_extract(b, role, 1)).alias("role"),
        F.split(F.regexp_replace(b, head, ""), r"\[/INST\]").alias("texts"))))
    return parsed.select(
        "conv_id", "formatted", "loss_spans",
        F.flatten(F.transform("_parsed", lambda b: F.transform(
            F.slice(b["texts"], F.lit(1), F.size(b["texts"]) - 1),
            lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"))))).alias("turns"),
        F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
            F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))),
            "").alias("loss_text"),
    )
