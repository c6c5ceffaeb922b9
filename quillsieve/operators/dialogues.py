"""Preparing, parsing and screening multi-turn dialogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import whole_div
from ..functions.matching import blocked
from ..functions.patterns import TermList
from ..functions.strictjson import parse_single
from ..runtime import spread
from .filters import is_safe_verdict

MESSAGES = "array<struct<role:string,content:string>>"

# Shortest accepted dialogue and the roles it may contain.
MIN_MESSAGES = 4
ROLES = ["user", "assistant"]

# The request sent to the dialogue writer.
PROMPT = (
    "Generate a tutoring conversation where a child asks about: %s\n"
    "Variation %d: Make it feel unique and natural."
)

# Variations written per topic.
VARIATIONS = 50

# Stands between messages that are matched together.
MESSAGE_BREAK = "\x01"

# Pieces joined by one aggregation buffer.
PIECE_SPAN = 1024


def topic_grid(topics: DataFrame, variations: int = VARIATIONS, topic: str = "topic") -> DataFrame:
    """Every topic with variation 1..n and its rendered prompt (a row-local expansion)."""
    grid = topics.withColumn("variation", F.explode(F.sequence(F.lit(1), F.lit(variations))))
    return grid.withColumn("prompt", F.format_string(PROMPT, F.col(topic), F.col("variation")))


def extract_messages(reply: Column) -> Column:
    """Parse the span from the first "[" to the last "]"; null if there is none or it is broken."""
    found = F.regexp_extract(reply, r"(?s)\[.*\]", 0)
    return parse_single(F.nullif(found, F.lit("")), MESSAGES)


def messages_valid(messages: Column) -> Column:
    """At least four messages, known roles, content present, and the user speaks first."""
    well_formed = F.forall(
        messages, lambda m: m["role"].isin(ROLES) & m["content"].isNotNull()
    )
    starts = F.get(messages, F.lit(0))["role"] == "user"
    return F.coalesce((F.size(messages) >= MIN_MESSAGES) & well_formed & starts, F.lit(False))


def messages_text(messages: Column) -> Column:
    return F.array_join(
        F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n"
    )


def messages_blocked(messages: Column, terms: TermList) -> Column:
    """True when any single message contains a blocked term.

    The contents are matched as one text; the separator is no letter, no space
    and in no term, so nothing matches across messages.
    """
    contents = F.array_join(F.transform(messages, lambda m: m["content"]), MESSAGE_BREAK)
    return blocked(contents, terms)


def valid_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The structural rules on the long form, one row per conversation.

    Plain mergeable aggregates: a conversation of any length is summed up
    map-side and never gathered.
    """
    good = F.coalesce(F.col(role).isin(ROLES) & F.col(text).isNotNull(), F.lit(False))
    per = turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("messages"),
        F.bool_and(good).alias("_good"),
        F.min_by(role, turn).alias("_first"),
    )
    ok = (F.col("messages") >= MIN_MESSAGES) & F.col("_good") & (F.col("_first") == "user")
    return per.select(key, "messages", F.coalesce(ok, F.lit(False)).alias("is_valid"))


def blocked_conversations(
    turns: DataFrame, terms: TermList, key: str = "conv_id", text: str = "text"
) -> DataFrame:
    """Blocked-message count and verdict per conversation (map-side combined)."""
    return (
        spread(turns.select(key, text))
        .select(key, blocked(F.col(text), terms).alias("_hit"))
        .groupBy(key)
        .agg(F.count_if("_hit").alias("blocked_messages"))
        .withColumn("is_blocked", F.col("blocked_messages") > 0)
    )


def joined_text(
    rows: DataFrame, key: str, order: str, piece: Column, separator: str = "", out: str = "text"
) -> DataFrame:
    """Concatenate the pieces of a key in ``order`` (a non-negative integer); nulls are skipped.

    Runs of consecutive pieces are joined first, spread over the cluster, so a
    long key arrives at its last step as a few large strings.
    """
    run = F.struct(F.col(order).alias("order"), F.col("_piece").alias("piece"))

    def glue(items: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(items), lambda p: p["piece"]), separator)

    runs = (
        rows.select(key, order, piece.alias("_piece"))
        .groupBy(key, whole_div(F.col(order), PIECE_SPAN).alias("_run"))
        .agg(F.collect_list(run).alias("_items"))
        .select(key, "_run", glue(F.col("_items")).alias("_piece"))
    )
    parts = F.struct(F.col("_run").alias("order"), F.col("_piece").alias("piece"))
    return runs.groupBy(key).agg(F.collect_list(parts).alias("_items")).select(
        key, glue(F.col("_items")).alias(out)
    )


def conversation_text(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    line = F.concat(F.col(role), F.lit(": "), F.col(text))
    return joined_text(turns, key, turn, line, "\n")


def conversation_json(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``key, messages``: the dialogue as one JSON array of ``{role, content}`` objects."""
    message = F.to_json(F.struct(F.col(role).alias("role"), F.col(text).alias("content")))
    listed = joined_text(turns, key, turn, message, ",", "messages")
    return listed.withColumn("messages", F.concat(F.lit("["), "messages", F.lit("]")))


def dialogue_status(
    replies: DataFrame, terms: TermList, reply: str = "reply", verdict: str = "verdict"
) -> DataFrame:
    """Parse each reply and label it ``failed``, ``rejected`` or ``ok``.

    The blocklist is tested before the verdict, and only on parsed replies.
    """
    parsed = spread(replies).withColumn("messages", extract_messages(F.col(reply)))
    unsafe = messages_blocked(F.col("messages"), terms) | ~is_safe_verdict(F.col(verdict))
    status = (
        F.when(~messages_valid(F.col("messages")), "failed").when(unsafe, "rejected").otherwise("ok")
    )
    return parsed.withColumn("status", status)


def status_funnel(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("dialogues"))
