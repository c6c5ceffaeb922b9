"""Reassembling token streams from logged event lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.strictjson import parse_single
from ..functions.textnorm import FRAME_WHITESPACE, strip
from ..operators.dialogues import joined_text

# The event-line prefix and the end-of-stream payload.
DATA_PREFIX = "data:"
END_PAYLOAD = "[DONE]"


# Event time without a line after which a stream is given up.
PATIENCE = "10 minutes"


def with_tokens(lines: DataFrame, line: str = "line", out: str = "token", ended: str | None = None) -> DataFrame:
    """Replace an event line by its token; ``ended`` names a column for "this line ends the stream".

    Other lines, the end mark, and broken or empty payloads give an empty token.
    Each step is its own column, so no line is trimmed or parsed repeatedly.
    """
    trimmed = lines.withColumn("_line", strip(F.col(line), FRAME_WHITESPACE)).drop(line)
    payload = strip(F.substring("_line", len(DATA_PREFIX) + 1, 1 << 30), FRAME_WHITESPACE)
    framed = trimmed.withColumn(
        "_payload", F.when(F.col("_line").startswith(DATA_PREFIX), payload)
    ).drop("_line")
    token = F.when(
        F.col("_payload") != END_PAYLOAD,
        parse_single(F.col("_payload"), "struct<token:string>")["token"],
    )
    if ended:
        done = parse_single(F.col("_payload"), "struct<done:boolean>")["done"]
        framed = framed.withColumn(ended, F.coalesce((F.col("_payload") == END_PAYLOAD) | done, F.lit(False)))
    return framed.withColumn(out, F.coalesce(token, F.lit(""))).drop("_payload")


def reassemble(
    lines: DataFrame, stream: str = "stream_id", seq: str = "seq", line: str = "line"
) -> DataFrame:
    """Full text per stream; a stream without tokens yields an empty text."""
    return joined_text(with_tokens(lines, line, "token"), stream, seq, F.col("token"))


def reassemble_stream(
    lines: DataFrame,
    stream: str = "stream_id",
    seq: str = "seq",
    line: str = "line",
    event_time: str | None = None,
    patience: str = PATIENCE,
) -> DataFrame:
    """Streaming form: emits each contiguous piece as soon as its gap is closed.

    Lines are numbered from 0 per stream and may arrive late or twice. State
    holds the next expected number and the lines waiting for it, not the text
    already emitted, so it is bounded by the disorder and not by the stream.

    With ``event_time`` (a timestamp column of the lines) a stream without news
    for ``patience`` is closed: what waits behind a lost line is emitted as in
    the batch form, and the state goes. Until then repeats are ignored, also
    after the end mark. Without it nothing tells a late line from a lost one; a
    stream that ended keeps two numbers of state.
    """

    def advance(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        following, end, waiting = 0, -1, {}
        if state.exists:
            following, end, numbers, texts = state.get
            waiting = dict(zip(numbers, texts))
        latest = 0
        if state.hasTimedOut:
            state.remove()
            ready = sorted(waiting)
            starts = [n for n, seq in enumerate(ready) if n == 0 or seq != ready[n - 1] + 1]
        else:
            for pdf in batches:
                numbers, ended = pdf["seq"].to_numpy(), pdf["ended"].to_numpy()
                due = np.flatnonzero(numbers >= following)
                waiting.update(zip(numbers[due].astype(np.int64).tolist(), pdf["token"].to_numpy()[due].tolist()))
                if ended.any():
                    end = max(end, int(np.nanmax(numbers[ended])))
                if event_time:
                    latest = max(latest, int(pdf["at"].max().timestamp() * 1000))
            ready, due_next = [], following
            while due_next in waiting:
                ready.append(due_next)
                due_next += 1
            starts, following = [0] if ready else [], due_next
            rest = sorted(n for n in waiting if n >= following)
            state.update((following, end, rest, [waiting[n] for n in rest]))
            if event_time:
                state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + 1)
        if starts:
            ends = [*starts[1:], len(ready)]
            yield pd.DataFrame(
                {
                    "stream_id": [key[0]] * len(starts),
                    "from_seq": [ready[low] for low in starts],
                    "piece": ["".join(waiting[n] for n in ready[low:high]) for low, high in zip(starts, ends)],
                }
            )

    timed = [F.col(event_time).alias("at")] if event_time else []
    tokens = with_tokens(lines, line, "token", "ended").select(
        F.col(stream).cast("string").alias("stream_id"), F.col(seq).cast("bigint").alias("seq"), "token", "ended", *timed
    )
    if event_time:
        tokens = tokens.withWatermark("at", patience)
    return tokens.groupBy("stream_id").applyInPandasWithState(
        advance,
        "stream_id string, from_seq bigint, piece string",
        "following bigint, ended_at bigint, numbers array<bigint>, texts array<string>",
        "append",
        GroupStateTimeout.EventTimeTimeout if event_time else GroupStateTimeout.NoTimeout,
    )
