"""Chat formatting from an event log, with DataFrame and SQL functions only.

A conversation is a log of events (conv_id, turn, seq, kind, role, text):
``message`` opens a message at a turn, ``delta`` appends a streamed piece,
``edit`` replaces the text, ``regenerate`` drops it and begins anew with the
event's text. Events are partitioned by conversation and turn, sorted by
sequence and folded: a running count of openings separates messages, a
running count of resets separates the text's generations, and only the last
generation's pieces are joined. A conversation of many turns is thus folded
in as many groups as it has turns; it meets as a whole only when its rendered
turns, joined in blocks of ``BLOCK`` turns before, become one string.

Template, a turn each: ``<turn>ROLE<text>TEXT</turn>`` and a newline. In roles
and texts a backslash becomes ``\\b`` and ``<`` becomes ``\\l``, so no control
string can occur in them, and the way back is two plain replacements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<turn>", "<text>", "</turn>\n"
BLOCK = 64


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """The final messages: conv_id, turn, nth (of several messages at one
    turn, from 1; 0 if deltas came without an opening), role, text.

    Null texts and roles are empty, a null kind is ``message``; null
    conversation ids form one conversation, null turns come first. Events with
    equal seq are ordered by kind, role and text, so the result does not
    depend on the order of rows; a message repeated as a row is repeated."""
    e = events.select("conv_id", "turn", "seq", F.coalesce("kind", F.lit("message")).alias("kind"),
                      F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["seq", F.col("kind").desc(), "role", "text"]
    w = Window.partitionBy("conv_id", "turn").orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    e = (e.withColumn("at", F.row_number().over(w))
         .withColumn("nth", F.sum((F.col("kind") == "message").cast("int")).over(so_far))
         .withColumn("gen", F.sum((F.col("kind") != "delta").cast("int")).over(so_far)))
    whole = Window.partitionBy("conv_id", "turn", "nth")
    e = e.withColumn("role", F.min_by("role", "at").over(whole)).withColumn("last", F.max("gen").over(whole))
    pieces = F.array_sort(F.collect_list(F.struct("at", "text")))
    return (e.where(F.col("gen") == F.col("last")).groupBy("conv_id", "turn", "nth", "role")
            .agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text")))


def format_chats(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_mask: an array with (turn_chars, loss_from,
    loss_chars) per turn, in code points of ``formatted``; the tokens of
    ``loss_chars`` characters from ``loss_from`` (counted in the turn) are
    trained on. An empty table gives no conversation."""
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    turns = fold_events(events).select(
        "conv_id", "turn", "nth", F.concat(head, body, F.lit(END)).alias("turn_text"),
        F.struct((F.char_length(head) + F.char_length(body) + len(END)).alias("turn_chars"),
                 F.char_length(head).alias("loss_from"),
                 F.when(F.col("role").isin(*loss_roles), F.char_length(body)).otherwise(0).alias("loss_chars")
                 ).alias("mask"))
    blocks = (turns.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("turn", "nth", "turn_text", "mask"))).alias("t"))
              .select("conv_id", "block", F.array_join(F.col("t.turn_text"), "").alias("block_text"),
                      F.col("t.mask").alias("masks")))
    return (blocks.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("block", "block_text", "masks"))).alias("b"))
            .select("conv_id", F.array_join(F.col("b.block_text"), "").alias("formatted"),
                    F.flatten(F.col("b.masks")).alias("loss_mask")))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, and what it holds: ``turns``, an array of (role,
    text) parsed from the text alone, and ``loss_text``, all text under the
    mask, unescaped."""
    pieces = F.slice(F.split("formatted", END, -1), 1, F.size(F.split("formatted", END, -1)) - 1)
    parsed = F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(F.split_part(p, F.lit(TEXT), F.lit(1)), F.lit(len(TURN) + 1))).alias("role"),
        unescape(F.split_part(p, F.lit(TEXT), F.lit(2))).alias("text")))
    under = F.zip_with(pieces, "loss_mask", lambda p, m: unescape(
        F.substr(p, m["loss_from"] + 1, m["loss_chars"])))
    return chats.select("conv_id", "formatted", parsed.alias("turns"), F.array_join(under, "").alias("loss_text"))
