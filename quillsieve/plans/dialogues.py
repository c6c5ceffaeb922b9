"""Dialogue requests out, screened replies in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import SHUFFLE_SEED
from ..functions.patterns import TermList
from ..operators.dialogues import VARIATIONS, dialogue_status, topic_grid
from ..operators.packing import sample_rows, window_of

# Dialogues asked for by default.
TARGET_DIALOGUES = 5000


def request_table(
    topics: DataFrame,
    existing: int = 0,
    target: int = TARGET_DIALOGUES,
    variations: int = VARIATIONS,
    seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """Prompts still to send, in seeded order, after ``existing`` finished ones.

    ``topics`` has ``topic_id`` and ``topic``.
    """
    grid = topic_grid(topics, variations).withColumn(
        "task_id", F.concat_ws(":", "topic_id", "variation")
    )
    return window_of(grid, "task_id", existing, target, seed)


def pending_requests(
    topics: DataFrame,
    finished: DataFrame,
    target: int = TARGET_DIALOGUES,
    variations: int = VARIATIONS,
    seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """Prompts still to send for ``target`` dialogues: tasks that ``finished`` (task_id) doesn't list, in seeded order.

    Unlike request_table, which skips a count, this sends failed tasks again and
    finished ones never, in whatever order they came. ``pos`` numbers what is sent.
    """
    grid = topic_grid(topics, variations).withColumn("task_id", F.concat_ws(":", "topic_id", "variation"))
    done = finished.select("task_id").distinct()
    missing = max(0, target - done.count())
    return window_of(grid.join(done, "task_id", "left_anti"), "task_id", 0, missing, seed)


def screen_replies(replies: DataFrame, verdicts: DataFrame, terms: TermList, key: str = "task_id") -> DataFrame:
    """``replies`` (key, reply) with ``messages`` and ``status``; a missing verdict rejects."""
    joined = replies.join(verdicts.select(key, "verdict"), key, "left")
    return dialogue_status(joined, terms)


def accepted(screened: DataFrame, key: str = "task_id", target: int | None = None) -> DataFrame:
    """Accepted replies; of more than ``target`` the first in seeded order."""
    good = screened.where(F.col("status") == "ok")
    return good if target is None else sample_rows(good, target, key, SHUFFLE_SEED)
