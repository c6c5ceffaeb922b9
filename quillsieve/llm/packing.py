"""Packing of token pieces into windows by Karmarkar-Karp multiway differencing.

Every document is cut into windows that are full from the start, and the rest
into items. Items fall into groups of about ``GROUP_WINDOWS`` windows by a hash
of their row. Within a group each item begins as a partition of the group with
one window filled; the two partitions with the largest imbalance are merged
again and again, the fullest window of one with the emptiest of the other,
until one partition is left whose windows are nearly equal. If its fullest
window exceeds the capacity, the group gets one more window and is packed anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillsieve.llm import arrow
from quillsieve.llm.tokens import tokenizer
from quillsieve.runtime import materialize

CAPACITY = 2048
END_ID = 1
# Longest item beside the full windows: a window holds eight or more, so imbalances can cancel.
ITEM_TOKENS = 256
# Windows a group is expected to fill; one window too many costs 1/128 of padding.
GROUP_WINDOWS = 128


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, by multiway differencing into ``windows`` windows."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, np.int64)
    # A partition: window sums in descending order less the smallest, and a slot number for each.
    first = np.arange(windows)
    sums, slots = {}, {}
    left = np.empty((max(n - 1, 0), windows), np.int64)
    right = np.empty_like(left)
    for i, size in enumerate(sizes.tolist()):
        sums[i] = np.zeros(windows, np.int64)
        sums[i][0] = size
        slots[i] = first + i * windows
    heap = [(-size, i) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    for step in range(n - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        left[step], right[step] = slots.pop(a)[order], slots.pop(b)[::-1][order]
        made = n + step
        sums[made], slots[made] = total - total[-1], first + made * windows
        heapq.heappush(heap, (-int(sums[made][0]), made))
    window = np.empty((2 * n - 1) * windows, np.int64)
    window[(2 * n - 2) * windows :] = first
    for step in range(n - 2, -1, -1):
        own = window[(n + step) * windows : (n + step + 1) * windows]
        window[left[step]] = own
        window[right[step]] = own
    return window[np.arange(n) * windows]


def pack_group(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each item; as many windows as it takes for none to exceed ``capacity``."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, windows)
        if np.bincount(window, sizes, windows).max() <= capacity:
            return window
        windows += 1


def cut_documents(
    docs: DataFrame, path: str, *, capacity: int = CAPACITY, item_tokens: int = ITEM_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and cut them: doc_id, start, length, doc_tokens, ids (uint32, little-endian).

    A null text has only its end id. Rows with equal or null doc_id are documents of their own.
    """
    if not 0 < item_tokens <= capacity:
        raise ValueError("item_tokens must be between 1 and capacity")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches, "text"):
            ids, counts = tokenizer(path).encode(part.column("text"))
            flat = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            full = counts // capacity
            pieces = full + -(-(counts - full * capacity) // item_tokens)
            doc = np.repeat(np.arange(len(counts)), pieces)
            rank = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.where(rank < full[doc], rank * capacity, full[doc] * capacity + (rank - full[doc]) * item_tokens)
            end = np.minimum(counts[doc], start + np.where(rank < full[doc], capacity, item_tokens))
            yield arrow.batch(
                schema, part.column("doc_id").take(pa.array(doc)), start, end - start, counts[doc],
                arrow.binaries(flat, (np.cumsum(counts) - counts)[doc] + end),
            )

    kind = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, kind)


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Add sequence_id and offset to stored ``pieces`` (any columns beside ``length``).

    ``pieces`` must be a stored table: the row numbers that name groups are then
    the same whenever a task is repeated. Pieces of full capacity are sequences
    by themselves and don't move; items are shuffled once, by group.
    """
    kept = pieces.columns
    row, group = "__piece_row", "__piece_group"
    numbered = pieces.withColumn(row, F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") >= capacity).select(
        *kept, (F.col(row) * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    items = numbered.where(F.col("length") < capacity)
    total = items.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_windows)))
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(row, ignore_index=True)
        sizes = pdf["length"].to_numpy(np.int64)
        window = pack_group(sizes, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(sizes[order])
        heads = np.flatnonzero(np.diff(window[order], prepend=-1))
        before = np.repeat((ends - sizes[order])[heads], np.diff(heads, append=len(order)))
        offset = np.empty(len(order), np.int64)
        offset[order] = ends - sizes[order] - before
        pdf["sequence_id"] = (int(pdf[group].iloc[0]) << 32 | window) * 2 + 1
        pdf["offset"] = offset
        return pdf.drop(columns=[row, group])

    packed = (
        items.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
        .groupBy(group)
        .applyInPandas(pack, schema)
    )
    return whole.unionByName(packed)


def stored_pieces(docs: DataFrame, path: str, **cut) -> DataFrame:
    """The pieces of cut_documents as a stored table.

    Empty input gives an empty table; columns beside doc_id and text are not read.
    """
    return materialize(cut_documents(docs, path, **cut), "pieces")


def pack(docs: DataFrame, path: str, **cut) -> DataFrame:
    """Documents (doc_id, text) as packed pieces with their ids."""
    return pack_pieces(stored_pieces(docs, path, **cut))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order: sequence_id, n_tokens, ids (binary of uint32)."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(pieces, F.lit(b""), lambda left, x: F.concat(left, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
