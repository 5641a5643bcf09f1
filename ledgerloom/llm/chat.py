"""Conversations as marked text with a loss mask, and back, in Spark expressions only.

A run of turns by one role is one block::

    <turn:role>
    text<and>text</turn>

Roles and texts are escaped so that they hold none of ``<``, ``>``: a backslash becomes ``\\b``, the
two brackets ``\\l`` and ``\\g``. So a mark in the output is always a mark, and the replacements can be
undone one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, HEAD_END, BETWEEN, CLOSE = "<turn:", ">\n", "<and>", "</turn>\n"
# In this order; undone backwards.
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
LEARNT = "assistant"
# Code points of a chunk of a formatted conversation that is read back.
_CHUNK = 1024


def escape(text: Column) -> Column:
    for plain, marked in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(marked))
    return text


def unescape(text: Column) -> Column:
    for plain, marked in reversed(_ESCAPES):
        text = F.replace(text, F.lit(marked), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, learnt: str = LEARNT) -> DataFrame:
    """One row per conv_id: ``formatted`` and ``loss``, the spans (start from 0, length) to learn.

    ``turns`` has conv_id, turn, role, text; further columns are ignored. Turns are ordered by turn,
    then role, then text, null turns first; repeated rows stay. Null roles and texts are empty; rows
    without a conv_id form one conversation. A conversation is one output row and so one task's; it
    may have any number of turns that fits a row, and takes time in proportion to them.

    Which turns open and close a block, and where each begins, is told by their neighbours in order;
    then the turns are collected as structs, sorted, merged and joined.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("role", "text"))
    known = turns.select("conv_id", "turn", role, text)
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    opens = ~F.lag("role").over(ordered).eqNullSafe(F.col("role"))
    closes = ~F.lead("role").over(ordered).eqNullSafe(F.col("role"))
    pieces = known.select(
        "conv_id",
        F.row_number().over(ordered).alias("number"),
        F.when(opens, F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END))).otherwise(F.lit(BETWEEN)).alias("head"),
        escape(F.col("text")).alias("body"),
        F.when(closes, F.lit(CLOSE)).otherwise(F.lit("")).alias("tail"),
        (F.col("role") == learnt).alias("learnt"),
    )
    length = lambda name: F.length(name).cast("bigint")
    before = Window.partitionBy("conv_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length("head") + length("body") + length("tail")).over(before), F.lit(0))
    placed = pieces.select(
        "conv_id",
        F.struct(
            "number",
            F.concat("head", "body", "tail").alias("piece"),
            F.struct((start + length("head")).alias("start"), length("body").alias("length")).alias("span"),
            "learnt",
        ).alias("placed"),
    )
    collected = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("placed")).alias("placed"))
    return collected.select(
        "conv_id",
        F.array_join(F.col("placed.piece"), "").alias("formatted"),
        F.transform(F.filter("placed", lambda p: p["learnt"]), lambda p: p["span"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(formatted, OPEN)
    blocks = F.slice(parts, 2, F.size(parts))

    def turns_of(block: Column) -> Column:
        head = F.substring_index(block, HEAD_END, 1)
        body = F.substring(block, F.length(head) + len(HEAD_END) + 1, F.length(block))
        body = F.substring(body, F.lit(1), F.length(body) - len(CLOSE))
        texts = F.split(body, BETWEEN)
        return F.transform(texts, lambda t: F.struct(unescape(head).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask.

    The conversation is cut into chunks once, so that a span far from its start is not searched for
    from there.
    """
    chunks = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))

    def text_of(held: Column, span: Column) -> Column:
        first = F.floor(span["start"] / _CHUNK).cast("int")
        last = F.floor((span["start"] + span["length"]) / _CHUNK).cast("int")
        near = F.array_join(F.slice(held, first + 1, last - first + 1), "")
        return unescape(F.substring(near, (span["start"] % _CHUNK + 1).cast("int"), span["length"].cast("int")))

    # As the element of an array the chunks are worked out once, and not again for every span.
    texts = F.transform(F.array(chunks), lambda held: F.transform(loss, lambda span: text_of(held, span)))
    return F.element_at(texts, 1)
