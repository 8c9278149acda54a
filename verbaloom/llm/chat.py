"""Chat formatting from event logs (operator 2), in DataFrame operations only.

A log has a row per event: conv_id, message, seq, event, role, text. ``delta`` adds text to
a message, ``edit`` replaces what it has, ``regenerate`` empties it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template. A turn is <|role|>, a line feed, its text, <|end|>,
# a line feed.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"
# Code points in one streamed delta, and events in one message.
DELTA_CHARS, MESSAGE_EVENTS = 400, 1 << 24


def escape(text: Column) -> Column:
    """A backslash after every ``<``, ``[``, ``|`` and backslash: no control string, of
    this template or of one with ``</s>`` or ``[INST]``, is left whole."""
    return F.regexp_replace(text, r"([\\<\[|])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[|])\\", "$1")


def as_events(turns: DataFrame) -> DataFrame:
    """An event log of finished turns (conv_id, turn, role, text), as a chat front end would
    have sent them: assistants stream a first draft, are asked anew and stream the text;
    users type the beginning and edit it; others stream their text.

    Turns of one number are told apart by role and text; repeated rows are turns of their
    own. A null text is empty, a null role an empty one.
    """
    clean = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = clean.withColumn("message", (F.row_number().over(order) - 1).cast("bigint"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("event"), text.alias("text"))

    deltas = F.transform(pieces, lambda p: event("delta", p))
    begun = F.transform(F.slice(pieces, 1, 1), lambda p: event("delta", p))
    # An empty message is one empty delta.
    deltas = F.when(F.size(pieces) > 0, deltas).otherwise(F.array(event("delta", F.lit(""))))
    events = (
        F.when(F.col("role") == "assistant", F.concat(begun, F.array(event("regenerate", F.lit(""))), deltas))
        .when(F.col("role") == "user", F.concat(begun, F.array(event("edit", F.col("text")))))
        .otherwise(deltas)
    )
    return numbered.select("conv_id", "message", "role", F.posexplode(events).alias("at", "e")).select(
        "conv_id",
        "message",
        (F.col("message") * MESSAGE_EVENTS + F.col("at")).alias("seq"),
        "e.event",
        "role",
        "e.text",
    )


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: each message as its events leave it.

    Events are folded in order of ``seq`` inside their message: text counts from the last
    edit or regeneration on. An event delivered twice (equal in all columns) counts once;
    different events of one ``seq`` follow each other by kind and text. The role is that of
    the first event. Null texts add nothing; events of another kind are an error. Messages
    are folded before conversations are gathered, so a conversation of any length is
    spread over tasks here.
    """
    known = F.col("event").isin("delta", "edit", "regenerate")
    text = F.when(F.col("event") == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    checked = F.when(known, text).otherwise(
        F.raise_error(F.concat(F.lit("unknown event: "), F.coalesce("event", F.lit("null")))).cast("string")
    )
    one = F.struct("seq", "event", checked.alias("text"))
    folded = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_set(one)).alias("parts"),
        F.max(F.when(F.col("event") != "delta", F.struct("seq", "event"))).alias("reset"),
        F.min(F.struct("seq", F.coalesce("role", F.lit("")).alias("role"))).alias("first"),
    )
    reset = F.col("reset")
    counts = F.filter(
        "parts",
        lambda p: reset.isNull() | (F.struct(p["seq"], p["event"]) >= reset),
    )
    return folded.select(
        "conv_id",
        "message",
        F.col("first.role").alias("role"),
        F.array_join(F.transform(counts, lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """conv_id, segments, formatted: every conversation in the template.

    ``segments`` (array of text, loss) in order are ``formatted``; loss marks the texts
    of the ``learned`` role, without their marks. One row per conversation, which holds
    its whole text; messages of one number are ordered by role and text. An empty table
    gives no rows.
    """
    turns = messages.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", "role", "text"))).alias("turns")
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def turn(t: Column) -> Column:
        no = F.lit(False)
        return F.array(
            segment(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE)), no),
            segment(escape(t["text"]), t["role"] == learned),
            segment(F.lit(END), no),
        )

    made = turns.select("conv_id", F.flatten(F.transform("turns", turn)).alias("segments"))
    return made.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def parse(formatted: Column) -> Column:
    """The turns (array of role, text) of a rendered conversation: the inverse of ``render``."""
    cut = F.split(formatted, r"<\|end\|>\n", -1)
    shape = r"(?s)^<\|(.*?)\|>\n(.*)$"
    return F.transform(
        F.slice(cut, 1, F.size(cut) - 1),
        lambda t: F.struct(
            unescape(F.regexp_extract(t, shape, 1)).alias("role"),
            unescape(F.regexp_extract(t, shape, 2)).alias("text"),
        ),
    )


def learned_text(segments: Column) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescape(s["text"])), "")
