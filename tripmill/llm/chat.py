"""Conversations as training text with a loss mask, in Spark expressions only.

Template: ``### role: text</turn>`` and a line feed per block. Adjacent turns of one role form one block,
their texts parted by ``<next/>``. Inside roles and texts ``\\``, ``<``, ``#`` and ``:`` (roles only) are
written as ``\\s``, ``\\l``, ``\\h`` and ``\\c``: an escaped text contains neither ``<`` nor ``#``, so no text can
form a control string, and each escape begins at its own backslash, so undoing them is unambiguous.

Turns are ordered by turn number, ties by role and text. A NULL text or role is empty; NULL turn numbers come
first; rows with a NULL conversation id form one conversation. Repeated rows stay repeated. An empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import table

NEXT, END = "<next/>", "</turn>\n"
_ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))
LOSS_ROLE = "assistant"
_SPAN = "array<struct<start:int,length:int>>"


def escaped(text: Column, also: tuple = ()) -> Column:
    for plain, mark in (*_ESCAPES, *also):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    # The backslash comes last: what it gives must not be taken for another escape.
    for plain, mark in ((":", "\\c"), *reversed(_ESCAPES)):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are code point ranges of the texts of ``loss_role``.

    Each turn's text has a span of its own, without control strings, in order.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    turn = F.struct(
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written_turns = F.transform(
        "turns",
        lambda t: F.struct(
            t.role.alias("role"),
            escaped(t.text).alias("text"),
            F.concat(F.lit("### "), escaped(t.role, ((":", "\\c"),)), F.lit(": ")).alias("head"),
        ),
    )
    # What stands before and after a text depends on the neighbouring roles: merged blocks in one pass.
    pieces = F.transform(
        "escaped",
        lambda t, i: F.struct(
            F.when((i > 0) & (F.get("escaped", i - 1).role == t.role), F.lit(NEXT)).otherwise(t.head).alias("before"),
            t.text.alias("text"),
            F.when(F.get("escaped", i + 1).role == t.role, F.lit("")).otherwise(F.lit(END)).alias("after"),
            (t.role == loss_role).alias("loss"),
        ),
    )
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans")),
        lambda acc, p: F.struct(
            (acc.at + F.length(p.before) + F.length(p.text) + F.length(p.after)).alias("at"),
            F.when(
                p.loss,
                F.concat(
                    acc.spans,
                    F.array(F.struct((acc.at + F.length(p.before)).alias("start"), F.length(p.text).alias("length"))),
                ),
            )
            .otherwise(acc.spans)
            .alias("spans"),
        ),
        lambda acc: acc.spans,
    )
    return (
        grouped.select("conv_id", written_turns.alias("escaped"))
        .select("conv_id", pieces.alias("pieces"))
        .select(
            "conv_id",
            F.array_join(F.transform("pieces", lambda p: F.concat(p.before, p.text, p.after)), "").alias("formatted"),
            spans.alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    parts = F.transform(
        blocks,
        lambda b: F.struct(
            unescaped(F.substring_index(F.substring(b, 5, 1 << 30), ": ", 1)).alias("role"),
            F.split(F.substr(b, F.instr(b, ": ") + 2), NEXT).alias("texts"),
        ),
    )
    return F.flatten(
        F.transform(parts, lambda p: F.transform(p.texts, lambda t: F.struct(p.role.alias("role"), unescaped(t).alias("text"))))
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the mask."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s.start + 1, s.length))), "")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings in its texts, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    done = format_conversations(turns.union(probe))
    back = done.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
