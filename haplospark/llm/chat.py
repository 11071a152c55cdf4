"""Conversations as training text: one example per assistant turn, only its reply trainable.

Everything here is built-in functions. A turn is written as ``### role: text</turn>`` and a
newline. Within texts and roles the backslash becomes ``\\0``, the end mark ``\\1`` and, in
roles, the colon ``\\2``; so a mark in formatted text is always a real one, and reading back
gives the original.

Defined cases: a null text or role is empty; rows of one conversation are ordered by turn
(null first), then role and text; repeated rows are turns of their own; a null conversation
id is a conversation; a conversation without assistant turns is formatted and has no example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"
_TEXT_MARKS = (("\\", "\\0"), ("</turn>", "\\1"))
_ROLE_MARKS = (*_TEXT_MARKS, (":", "\\2"))


def _escape(column: Column, marks: tuple) -> Column:
    for plain, written in marks:
        column = F.replace(column, F.lit(plain), F.lit(written))
    return column


def unescape(column: Column) -> Column:
    """The original of an escaped text or role."""
    for plain, written in reversed(_ROLE_MARKS):
        column = F.replace(column, F.lit(written), F.lit(plain))
    return column


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, its whole text as ``formatted``, and its ``replies``.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. A reply holds the
    number of turns before it and the code points where its text starts and stops. Offsets
    are running sums in the window that the grouping then reuses: one shuffle in all.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "_role", "_text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        turns.select("conv_id", "turn", role.alias("_role"), text.alias("_text"))
        .withColumn("_head", F.concat(F.lit(OPEN), _escape(F.col("_role"), _ROLE_MARKS), F.lit(MIDDLE)))
        .withColumn("_body", _escape(F.col("_text"), _TEXT_MARKS))
        .withColumn("_long", F.length("_head") + F.length("_body") + len(CLOSE))
        .select(
            "conv_id",
            F.struct(
                F.row_number().over(in_order).alias("number"),
                F.coalesce(F.sum("_long").over(before), F.lit(0)).alias("at"),
                F.length("_head").alias("head"),
                F.length("_body").alias("body"),
                (F.col("_role") == TRAINED_ROLE).alias("trained"),
                F.concat("_head", "_body", F.lit(CLOSE)).alias("piece"),
            ).alias("_turn"),
        )
    )
    start = lambda t: t["at"] + t["head"]
    return (
        pieces.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
        .select(
            "conv_id",
            F.array_join(F.col("_turns")["piece"], "").alias("formatted"),
            F.transform(
                F.filter("_turns", lambda t: t["trained"]),
                lambda t: F.struct(
                    (t["number"] - 1).cast("long").alias("turns_before"),
                    start(t).cast("long").alias("start"),
                    (start(t) + t["body"]).cast("long").alias("stop"),
                ),
            ).alias("replies"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of formatted text, as an array of role and text."""
    pieces = F.split(formatted, r"\Q" + CLOSE + r"\E", -1)
    whole = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, MIDDLE, 1)
        body = F.substr(piece, F.length(role) + len(MIDDLE) + 1)
        return F.struct(
            unescape(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"),
            unescape(body).alias("text"),
        )

    return F.transform(whole, turn)


def expand_replies(conversations: DataFrame, outer: bool = False) -> DataFrame:
    """One row per reply: ``example`` (from 0), the text up to the reply's end, the mask.

    ``text`` holds all turns before and the reply with its end mark; the code points from
    ``loss_start`` to ``loss_stop`` are trainable, nothing else is. Examples are prefixes of
    one text, cut out row by row, so a task holds one of them at a time. With ``outer`` a
    conversation without replies keeps a row of nulls. Other columns are kept.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    keep = [c for c in conversations.columns if c not in ("formatted", "replies")]
    return conversations.select("*", explode("replies").alias("example", "_reply")).select(
        *keep,
        "example",
        F.col("_reply.turns_before").alias("turns_before"),
        F.substr("formatted", F.lit(1), (F.col("_reply.stop") + len(CLOSE)).cast("int")).alias("text"),
        F.col("_reply.start").alias("loss_start"),
        F.col("_reply.stop").alias("loss_stop"),
    )


def masked_text(text: Column, start: Column, stop: Column) -> Column:
    """The original of what lies under the mask."""
    return unescape(F.substr(text, (start + 1).cast("int"), (stop - start).cast("int")))


def planted_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold what templates use as control strings."""
    role = F.when(F.col("id") == 0, "user").otherwise(TRAINED_ROLE)
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        role.alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )


def chat_digests(turns: DataFrame) -> DataFrame:
    """Per conversation, what is read back from its formatted text and its examples."""
    said = F.transform(
        read_turns(F.col("formatted")),
        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
    )
    conversations = (
        format_conversations(turns)
        .withColumn("_said", said)
        .select(
            "conv_id",
            "formatted",
            "replies",
            F.size("_said").cast("long").alias("n_turns"),
            F.sha2(F.array_join("_said", ""), 256).alias("turns_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
    known = ["conv_id", "n_turns", "turns_sha256", "formatted_chars"]
    replies = expand_replies(conversations, outer=True).select(
        *known,
        F.struct(
            "example",
            masked_text(F.col("text"), F.col("loss_start"), F.col("loss_stop")).alias("reply"),
        ).alias("_learnt"),
    )
    learnt = F.array_join(F.sort_array(F.collect_list("_learnt"))["reply"], "")
    return (
        replies.groupBy("conv_id")
        .agg(
            *[F.first(c).alias(c) for c in known[1:]],
            F.count("_learnt.example").alias("n_examples"),
            learnt.alias("_loss"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("_loss").cast("long").alias("loss_chars"),
            F.sha2("_loss", 256).alias("loss_sha256"),
            "formatted_chars",
            "n_examples",
        )
    )
