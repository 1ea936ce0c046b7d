"""Chat rendering by perspective. DataFrame functions only.

Every participant of a conversation gets the dialogue rendered as if they were the assistant: their messages are
assistant turns and are masked in (their spans are what a model would learn), all others are users with their
names. Roles in ``context_roles`` (system) speak in every perspective and are no participants themselves.

    <|system|>            <|assistant|>            <|user:NAME|>
    text                  text                     text

with a line feed after the marker and after the text. ``<|`` inside a text is written ``< |``, so that no text can
pass for a marker. Spans count characters (code points) from the beginning of the part, end exclusive, and cover the
text of the turn without marker and line feeds.

A rendered dialogue comes in parts, so that a conversation of any length never meets in one row: a part holds the
turn numbers from ``part * part_turns`` on, ``part_turns`` of them. Messages of one turn number are ordered by role and
text. If a turn number has more than ``part_turns`` messages they are dealt by the hash of the message to further parts
(``piece``), as many as needed; elsewhere ``piece`` is 0.

A message with a NULL text has the empty text, a NULL role is the participant "unknown"; messages without a turn number
come first, in a part of their own (-1). Messages equal in conversation, turn, role and text are one message.
Messages without a conversation id belong to one conversation, NULL. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import col

PART_TURNS = 64
CONTEXT_ROLES = ("system",)


def _messages(df: DataFrame, part_turns: int, names: dict[str, str]) -> DataFrame:
    role = F.coalesce(col(names["role"]), F.lit("unknown"))
    text = F.replace(F.coalesce(col(names["text"]), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = df.select(col(names["conversation"]).alias("conv_id"), col(names["turn"]).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.distinct()
    crowded = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where(F.col("n") > part_turns)
    crowded = crowded.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.ceil(F.col("n") / part_turns).alias("pieces"))
    same = F.col("conv_id").eqNullSafe(F.col("c2")) & F.col("turn").eqNullSafe(F.col("t2"))
    piece = F.pmod(F.xxhash64("role", "text"), F.col("pieces"))
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1))
    rows = rows.join(crowded, same, "left").withColumn("piece", F.coalesce(piece, F.lit(0)).cast("int"))
    # a crowded turn has parts of its own, so that its pieces never share one with other turns
    return rows.select("conv_id", "turn", "role", "text", part.cast("long").alias("part"), "piece", F.when(F.col("pieces").isNotNull(), F.col("turn")).alias("alone"))


def rotate(
    df: DataFrame,
    part_turns: int = PART_TURNS,
    context_roles: tuple[str, ...] = CONTEXT_ROLES,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation, participant and part.

    ``conv_id``, ``speaker``, ``part``, ``alone`` (the turn number of a crowded turn, else NULL), ``piece``, ``n_turns``,
    ``text`` and ``mask``, the spans of the speaker's own messages as an array of (start, stop).
    """
    rows = _messages(df, part_turns, {"conversation": conversation, "turn": turn, "role": role, "text": text})
    speakers = rows.where(~F.col("role").isin(*context_roles)).select(F.col("conv_id").alias("c2"), F.col("role").alias("speaker")).distinct()
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("c2")))
    own = F.col("role") == F.col("speaker")
    marker = (
        F.when(own, F.lit("<|assistant|>\n"))
        .when(F.col("role").isin(*context_roles), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
        .otherwise(F.concat(F.lit("<|user:"), F.replace(F.col("role"), F.lit("|>"), F.lit("| >")), F.lit("|>\n")))
    )
    message = F.struct("turn", "role", F.col("text").alias("said"), marker.alias("marker"), own.alias("own"))
    groups = seen.groupBy("conv_id", "speaker", "part", "alone", "piece").agg(F.sort_array(F.collect_list(message)).alias("said"))
    whole = F.array_join(F.transform("said", lambda m: F.concat(m["marker"], m["said"], F.lit("\n"))), "")
    return groups.select(
        "conv_id", "speaker", "part", "alone", "piece", F.size("said").cast("long").alias("n_turns"), whole.alias("text"), _spans(F.col("said")).alias("mask")
    )


def _spans(said: Column) -> Column:
    """Spans of the speaker's messages; a running sum over the few messages of the part."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def add(state: Column, m: Column) -> Column:
        start = state["at"] + F.char_length(m["marker"])
        stop = start + F.char_length(m["said"])
        spans = F.when(m["own"], F.concat(state["spans"], F.array(F.struct(start.alias("start"), stop.alias("stop"))))).otherwise(state["spans"])
        return F.struct((stop + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(said, empty, add, lambda s: s["spans"])
