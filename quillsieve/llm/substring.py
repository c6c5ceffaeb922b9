"""Removal of passages that repeat earlier documents, found by fixed-block anchors.

1. Every document is cut into reference blocks of ``BLOCK`` words that don't
   overlap (the index), and windows of as many words roll over it (the probes).
   Index and probes meet by hash in buckets; a block that occurs in two documents
   leaves a mark at its place in each.
2. Around its marks a document's windows of ``WINDOW`` words get 96-bit hashes;
   the smallest document of each hash keeps its words. Windows that follow each
   other merge, so what goes are maximal exact repeats.

Every ``STEP``-th rolling window is a probe. Since STEP and BLOCK have no common
factor and STEP * BLOCK + BLOCK - 1 <= WINDOW, any repeat of WINDOW words holds a
place that is a block of one document and a probe of the other, so nothing is
missed; ``step=1`` probes every window with the same result.

Hashes travel as packed arrays, 5 bytes and a compressed place for an anchor.
Contents that are common within one slice of documents are settled there: their
anchors become marks at once, and only two of them go on to meet other slices.
Windows are reduced to the smallest document in the same way before they leave
a task. Texts move by a hash of doc_id and text, so rows without doc_id spread.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from quillsieve.llm import arrow
from quillsieve.llm.words import Words, read_words, rolling
from quillsieve.runtime import materialize

WINDOW = 50
BLOCK = 11
STEP = 3
# Text bytes behind one bucket of hashes, and those of one group of documents.
BUCKET_BYTES = 16 << 20
GROUP_BYTES = 4 << 20
_HEAD = "<QQQ"
_LAST = np.iinfo(np.int64).max


def pack_places(hashes: np.ndarray, width: int, docs: np.ndarray, marks: np.ndarray, places: np.ndarray) -> bytes:
    """Rows (hash, document, row mark, place) as bytes: ``width`` bytes of each hash, the rest compressed.

    ``hashes`` is an array of bytes, one row for each item.
    """
    order = np.lexsort((marks, docs))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(docs[order]) != 0) | (np.diff(marks[order]) != 0)
    index = np.empty(len(order), np.int64)
    index[order] = np.cumsum(fresh) - 1
    own = np.concatenate([docs[order[fresh]], marks[order[fresh]]])
    rest = np.concatenate([np.diff(index, prepend=0).astype("<i4"), places.astype("<u4").view("<i4")])
    packed = zstandard.ZstdCompressor(level=1).compress(own.astype("<i8").tobytes() + rest.tobytes())
    return struct.pack(_HEAD, len(docs), int(fresh.sum()), width) + hashes.tobytes() + packed


def unpack_places(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rows of pack_places: hashes as rows of bytes, documents, row marks, places."""
    count, own, width = struct.unpack_from(_HEAD, blob)
    at = struct.calcsize(_HEAD)
    hashes = np.frombuffer(blob, np.uint8, count * width, at).reshape(count, width)
    rest = zstandard.ZstdDecompressor().decompress(blob[at + count * width :])
    docs, marks = np.frombuffer(rest, "<i8", 2 * own).reshape(2, own)
    steps = np.frombuffer(rest, "<i4", 2 * count, 16 * own)
    index = np.cumsum(steps[:count])
    return hashes, docs[index], marks[index], steps[count:].view("<u4").astype(np.int64)


def _all_places(table: pa.Table, column: str) -> tuple[np.ndarray, ...]:
    parts = [unpack_places(x.as_py()) for x in table.column(column)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _by_key(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.diff(keys[order], prepend=-1))
    for low, high in zip(heads, [*heads[1:], len(order)]):
        yield int(keys[order[low]]), order[low:high]


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """doc_id as numbers; a missing one comes after all others."""
    return pc.fill_null(column.cast(pa.int64()), _LAST).to_numpy(zero_copy_only=False)


def _row_mark() -> Column:
    """Tells rows with one doc_id, or none, apart by their text."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text"))


def _groups_of(keys: np.ndarray, ids: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and document, where each key begins, and which keys have both roles and two documents."""
    order = np.lexsort((ids, keys))
    heads = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
    tails = np.append(heads[1:], len(order)) - 1
    shared = np.bitwise_or.reduceat(roles[order], heads) == 3
    return order, heads, shared & (ids[order][heads] < ids[order][tails])


def _anchors(docs: DataFrame, buckets: int, groups: int, window: int, block: int, step: int) -> DataFrame:
    """bucket, anchors (with hashes), and marks that were found within a slice (any bucket, no hashes)."""
    schema = pa.schema([("bucket", pa.int64()), ("anchors", pa.binary()), ("marks", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches, "text"):
            words = read_words(part.column("text"))
            long = words.sizes >= window
            place = np.arange(len(words.starts)) - np.repeat(words.first, words.sizes)
            last = np.repeat(np.where(long, words.sizes - block, -1), words.sizes)
            role = (place % block == 0) + 2 * (place % step == 0)
            at = np.flatnonzero((place <= last) & (role > 0))
            if not len(at):
                continue
            hashes = rolling(words.hashes(), block)[at]
            ids, marks = (np.repeat(x, words.sizes)[at] for x in (_ids(part.column("doc_id")), part.column("mark").to_numpy()))
            roles, places = role[at], place[at]
            order, heads, shared = _groups_of(hashes, ids, roles)
            settled = order[np.repeat(shared, np.diff(heads, append=len(order)))]
            goes = np.ones(len(order), bool)
            goes[settled] = False
            ends = order[np.concatenate([heads[shared], np.append(heads[1:], len(order))[shared] - 1])]
            goes[ends], roles[ends] = True, 3  # the smallest and the largest document stand for the content
            none = np.zeros((len(ids), 0), np.uint8)
            local = [
                (g % buckets, pack_places(none[settled[r]], 0, ids[settled[r]], marks[settled[r]], places[settled[r]]))
                for g, r in _by_key(marks[settled] % groups)
            ]
            yield arrow.batch(
                schema, pa.array([b for b, _ in local], pa.int64()), pa.nulls(len(local), pa.binary()),
                pa.array([x for _, x in local], pa.binary()),
            )
            hashes, ids, marks, roles, places = hashes[goes], ids[goes], marks[goes], roles[goes], places[goes]
            short = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:])
            made = [
                (b, pack_places(short[own], 5, ids[own], marks[own], places[own] * 4 + roles[own]))
                for b, own in _by_key(((hashes & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64))
            ]
            yield arrow.batch(
                schema, [b for b, _ in made], pa.array([x for _, x in made], pa.binary()), pa.nulls(len(made), pa.binary())
            )

    return docs.mapInArrow(cut, "bucket bigint, anchors binary, marks binary")


def _marks(anchors: DataFrame, groups: int) -> DataFrame:
    """Places of blocks that occur in two documents, one of them as a reference block: group, marks."""
    schema = pa.schema([("group", pa.int64()), ("marks", pa.binary())])

    def meet(table: pa.Table) -> pa.Table:
        ids, marks, places = (np.zeros(0, np.int64) for _ in range(3))
        with_hashes = table.filter(pc.is_valid(table.column("anchors")))
        if with_hashes.num_rows:
            short, ids, marks, coded = _all_places(with_hashes, "anchors")
            wide = np.zeros((len(short), 8), np.uint8)
            wide[:, :5] = short
            order, heads, shared = _groups_of(wide.view("<u8").reshape(-1), ids, coded & 3)
            own = order[np.repeat(shared, np.diff(heads, append=len(order)))]
            ids, marks, places = ids[own], marks[own], coded[own] >> 2
        settled = table.filter(pc.is_valid(table.column("marks")))
        if settled.num_rows:
            _, *more = _all_places(settled, "marks")
            ids, marks, places = (np.concatenate(x) for x in zip((ids, marks, places), more))
        if not len(ids):
            return schema.empty_table()
        none = np.zeros((len(ids), 0), np.uint8)
        made = [(g, pack_places(none[r], 0, ids[r], marks[r], places[r])) for g, r in _by_key(marks % groups)]
        return pa.table([[g for g, _ in made], pa.array([x for _, x in made], pa.binary())], schema=schema)

    return anchors.groupBy("bucket").applyInArrow(meet, "group bigint, marks binary")


def _words_of(table: pa.Table, doc_id: str, mark: str, text: str = "text") -> tuple[Words, np.ndarray, np.ndarray]:
    texts = table.column(text).cast(pa.large_string()).combine_chunks()
    return read_words(texts), _ids(table.column(doc_id)), table.column(mark).to_numpy()


def _locate(
    words: Words, rows: tuple[np.ndarray, np.ndarray], found: tuple[np.ndarray, np.ndarray], places: np.ndarray, width: int
) -> np.ndarray:
    """Word numbers of ((document, row mark), place), in every such row with ``width`` words from there."""
    count = len(rows[0])
    both = [np.concatenate(x) for x in zip(rows, found)]
    order = np.lexsort(both[::-1])
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(both[0][order]) != 0) | (np.diff(both[1][order]) != 0)
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(fresh)
    own, asked = name[:count], name[count:]
    order = np.argsort(own, kind="stable")
    low, high = (np.searchsorted(own[order], asked, side) for side in ("left", "right"))
    times = high - low
    row = order[np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    place = np.repeat(places, times)
    inside = place + width <= words.sizes[row]
    return words.first[row[inside]] + place[inside]


def _windows(docs: DataFrame, marks: DataFrame, buckets: int, window: int, block: int) -> DataFrame:
    """Window hashes around marks. kind 0: windows of the group's smallest documents, by bucket; 1: repeats, by group."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("rows", pa.binary())])

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        none = schema.empty_table()
        if not left.num_rows or not right.num_rows:
            return none
        words, ids, row_marks = _words_of(left, "doc_id", "mark")
        _, *found, places = _all_places(right, "marks")
        at = _locate(words, (ids, row_marks), tuple(found), places, block)
        count = len(words.starts)
        cover = np.zeros(count + 1, np.int64)
        np.add.at(cover, np.maximum(at + block - window, 0), 1)
        np.add.at(cover, at + 1, -1)
        place = np.arange(count) - np.repeat(words.first, words.sizes)
        fits = place + window <= np.repeat(words.sizes, words.sizes)
        begin = np.flatnonzero((np.cumsum(cover)[:count] > 0) & fits)
        if not len(begin):
            return none
        keys = np.zeros((len(begin), 12), np.uint8)
        head = rolling(words.hashes(0), window, 0)[begin]
        keys[:, :8] = head.astype("<u8").view(np.uint8).reshape(-1, 8)
        tail = rolling(words.hashes(1), window, 1)[begin]
        keys[:, 8:] = tail.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :4]
        owner, mark = (np.repeat(x, words.sizes)[begin] for x in (ids, row_marks))
        order, heads = _sorted_keys(keys, owner)
        smallest = np.empty(len(order), bool)
        smallest[order] = owner[order] == np.repeat(owner[order][heads], np.diff(heads, append=len(order)))
        out = [
            (0, b, pack_places(keys[r], 12, owner[r], mark[r], place[begin[r]]))
            for b, r in _by_key_of(np.flatnonzero(smallest), (head % np.uint64(buckets)).astype(np.int64))
        ]
        again = np.flatnonzero(~smallest)
        if len(again):
            group = left.column("group")[0].as_py()
            out.append((1, group, pack_places(keys[again, :0], 0, owner[again], mark[again], place[begin[again]])))
        return pa.table(
            [pa.array([x[0] for x in out], pa.int32()), [x[1] for x in out], pa.array([x[2] for x in out], pa.binary())],
            schema=schema,
        )

    pairs = docs.groupBy("group").cogroup(marks.groupBy("group"))
    return pairs.applyInArrow(extend, "kind int, key bigint, rows binary")


def _by_key_of(rows: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for key, own in _by_key(keys[rows]):
        yield key, rows[own]


def _sorted_keys(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by 12-byte key, then owner, and where each key begins."""
    first = np.ascontiguousarray(keys[:, :8]).view("<u8").reshape(-1)
    second = np.ascontiguousarray(keys[:, 8:]).view("<u4").reshape(-1)
    order = np.lexsort((owner, second, first))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order].astype(np.int64)) != 0)
    return order, np.flatnonzero(fresh)


def _repeats(windows: DataFrame, groups: int) -> DataFrame:
    """Windows of which a smaller document in another group has a copy: group, rows."""
    schema = pa.schema([("group", pa.int64()), ("rows", pa.binary())])

    def compare(table: pa.Table) -> pa.Table:
        keys, owner, mark, places = _all_places(table, "rows")
        order, heads = _sorted_keys(keys, owner)
        least = np.repeat(owner[order][heads], np.diff(heads, append=len(order)))
        again = order[owner[order] > least]
        made = [
            (g, pack_places(keys[again[r], :0], 0, owner[again[r]], mark[again[r]], places[again[r]]))
            for g, r in _by_key(mark[again] % groups)
        ]
        return pa.table([[g for g, _ in made], pa.array([x for _, x in made], pa.binary())], schema=schema)

    return windows.groupBy("key").applyInArrow(compare, "group bigint, rows binary")


def remove_repeats(
    docs: DataFrame,
    *,
    window: int = WINDOW,
    block: int = BLOCK,
    step: int = STEP,
    bucket_bytes: int = BUCKET_BYTES,
    group_bytes: int = GROUP_BYTES,
    names: tuple[str, str, str] = ("n_words", "n_removed", "kept_text"),
) -> DataFrame:
    """``docs`` (doc_id, text and any others) with n_words, n_removed and kept_text (see ``names``).

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller doc_id. kept_text is the other words, joined by one
    space; it is empty for a null text. Each row is judged by its own text: rows
    with equal doc_id do not remove each other's words, and neither do rows
    without one, which count as larger than all others. Rows that are equal in
    both lose the same words. Columns with the names of the results are
    replaced; all others stay, whatever their names.
    """
    if gcd(block, step) > 1 or block * step + block - 1 > window:
        raise ValueError("block and step miss repeats of this window")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, groups = max(least, -(-size // bucket_bytes)), max(least, -(-size // group_bytes))
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", _row_mark().alias("mark"))

    marks = materialize(_marks(_anchors(narrow, buckets, groups, window, block, step), groups), "marks")
    grouped = narrow.withColumn("group", F.pmod("mark", F.lit(groups)))
    windows = materialize(_windows(grouped, marks, buckets, window, block), "windows")
    apart = _repeats(windows.where("kind = 0").select("key", "rows"), groups)
    near = windows.where("kind = 1").select(F.col("key").alias("group"), "rows")
    repeats = materialize(apart.unionByName(near), "repeats")

    columns = [c for c in docs.columns if c not in names]
    # Names that no input has.
    mark, group = (f"{c}_{uuid.uuid4().hex}" for c in ("mark", "group"))
    whole = docs.select(*columns, _row_mark().alias(mark)).withColumn(group, F.pmod(mark, F.lit(groups)))
    out = whole.select(*columns).schema
    for name, kind in zip(names, ("long", "long", "string")):
        out = out.add(name, kind)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        words, ids, row_marks = _words_of(left, "doc_id", mark)
        gone = np.zeros(len(words.starts) + 1, np.int64)
        if right.num_rows:
            _, *found, places = _all_places(right, "rows")
            at = _locate(words, (ids, row_marks), tuple(found), places, window)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
        stays = np.cumsum(gone)[:-1] == 0
        first = words.first
        kept = []
        for low, count in zip(first.tolist(), words.sizes.tolist()):
            if count == 0:
                kept.append("")
                continue
            text = words.bytes_of(low, low + count).split()
            if not stays[low : low + count].all():
                text = [text[i] for i in np.flatnonzero(stays[low : low + count])]
            kept.append(b" ".join(text).decode())
        removed = np.zeros(len(first), np.int64)
        some = words.sizes > 0
        if some.any():
            removed[some] = np.add.reduceat((~stays).astype(np.int64), first[some])
        rest = left.select(columns)
        return (
            rest.append_column(names[0], pa.array(words.sizes, pa.int64()))
            .append_column(names[1], pa.array(removed, pa.int64()))
            .append_column(names[2], pa.array(kept, pa.string()))
        )

    return whole.groupBy(group).cogroup(repeats.groupBy("group")).applyInArrow(cut, out)
