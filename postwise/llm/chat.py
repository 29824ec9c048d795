"""Chat formatting with Spark expressions only.

Turns are collected per conversation, sorted, adjacent turns of one role merged
into one block, and concatenated:

    <|im_start|>role\\ntext<|im_cont|>text of the same role<|im_end|>\\n

``<|im_cont|>`` parts the merged turns, so the turns can be read back. Texts
and roles are escaped so that no control string can occur in them (``&`` becomes
``&amp;``, ``<|`` becomes ``&lt;|``, and a line feed in a role ``&#10;``); the
escape is reversible. The loss mask is the list of spans (start, length; code
points, 0-based) of the assistant's texts in the formatted string.

Defined results: a null role or text counts as empty; turns of equal number are
ordered by role and text; repeated rows stay; a null conversation id is a
conversation of its own; no rows give no conversations. One conversation is one
output cell, so it is bounded by the size of a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise.llm.common import bind

START, CONT, END = "<|im_start|>", "<|im_cont|>", "<|im_end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask array<struct<start, length>>."""
    t = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text")).alias("t"))
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    # A piece is the text of one turn with what stands before it; a block closes where the role changes.
    g = g.withColumn("pieces", bind(F.col("t"), lambda v: F.transform(v, lambda x, i: F.struct(
        F.when((i > 0) & (F.get(v, i - 1)["role"] == x["role"]), F.lit(CONT)).otherwise(F.concat(
            F.when(i > 0, F.lit(END + "\n")).otherwise(F.lit("")), F.lit(START), escape_role(x["role"]), F.lit("\n")
        )).alias("head"), x["text"].alias("text"), (x["role"] == loss_role).alias("loss")))))
    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).cast("bigint").alias("at"),
                           F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.char_length(p["head"]) + F.char_length(p["text"])).cast("bigint").alias("at"),
            F.when(p["loss"], F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.char_length(p["head"])).cast("bigint").alias("start"),
                F.char_length(p["text"]).cast("bigint").alias("length"))))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    return g.select("conv_id", F.concat(F.array_join(F.transform(
        "pieces", lambda p: F.concat(p["head"], p["text"])), ""), F.lit(END + "\n")).alias("formatted"),
        spans.alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array<struct<role, text>>, unescaped."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 2_000_000_000)
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substr(b, F.instr(b, "\n") + 1, F.char_length(b) - F.instr(b, "\n") - len(END) - 1),
                r"<\|im_cont\|>"),
        lambda x: F.struct(unescape_role(F.substring_index(b, "\n", 1)).alias("role"), unescape(x).alias("text")))))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(bind(formatted, lambda f: F.transform(mask, lambda s: unescape(F.substr(
        f, (s["start"] + 1).cast("int"), s["length"].cast("int"))))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: counts and digests of turns and loss text."""
    d = formatted.select("conv_id", read_turns(F.col("formatted")).alias("turns"),
                         read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
                         F.char_length("formatted").cast("bigint").alias("formatted_chars"))
    return d.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")
