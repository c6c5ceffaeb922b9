"""Token ids in files of patched frame-of-reference blocks.

A file holds consecutive documents: blocks of 4,096 ids, then an index of block
starts, then doc_id and id count of every document and a bit that is set if it
has a doc_id. A block keeps its minimum,
the differences to it packed at the width that ``PERCENTILE`` of them need, and
the wider ones as exceptions (position, difference). Differences are packed in
64 lanes of 64, so one vector operation handles a row of every block at once.

Layout, little-endian: blocks, each ``<III`` (width, minimum, exceptions),
width x 64 uint64, positions uint16, differences uint32; index of int64 block
starts; int64 doc_id, int64 counts; footer ``<QQQ`` (blocks, documents, ids).
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from quillsieve.llm import arrow
from quillsieve.llm.tokens import tokenizer
from quillsieve.runtime import materialize, run_dir

BLOCK = 4096
LANES = 64
PERCENTILE = 95
HEAD, HEAD_BYTES = "<III", 12
FOOT, FOOT_BYTES = "<QQQ", 24
# Blocks encoded or decoded at a time.
CHUNK = 256


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """One block for each 4,096 ids; the last is filled up with its last id."""
    if not len(ids):
        return []
    count = -(-len(ids) // BLOCK)
    rows = np.concatenate([ids, np.repeat(ids[-1:], count * BLOCK - len(ids))]).astype(np.uint32).reshape(count, BLOCK)
    low = rows.min(axis=1)
    delta = rows - low[:, None]
    rank = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    typical = np.partition(delta, rank, axis=1)[:, rank]
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.int64)
    blocks: list[bytes] = [b""] * count
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        wide = delta[own] >> np.uint32(width) != 0 if width < 32 else np.zeros((len(own), BLOCK), bool)
        lanes = np.where(wide, 0, delta[own]).astype(np.uint64).reshape(len(own), -1, LANES)
        words = np.zeros((len(own), width, LANES), np.uint64)
        for row in range(BLOCK // LANES if width else 0):
            word, shift = divmod(row * width, 64)
            words[:, word] |= lanes[:, row] << np.uint64(shift)
            if shift + width > 64:
                words[:, word + 1] |= lanes[:, row] >> np.uint64(64 - shift)
        for k, n in enumerate(own.tolist()):
            places = np.flatnonzero(wide[k])
            blocks[n] = b"".join(
                [
                    struct.pack(HEAD, width, int(low[n]), len(places)),
                    words[k].tobytes(),
                    places.astype("<u2").tobytes(),
                    delta[n, places].astype("<u4").tobytes(),
                ]
            )
    return blocks


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data``."""
    heads = [struct.unpack_from(HEAD, data, s) for s in starts.tolist()]
    widths = np.array([h[0] for h in heads], np.int64)
    out = np.zeros((len(heads), BLOCK), np.uint32)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        words = np.stack(
            [np.frombuffer(data, "<u8", width * LANES, int(starts[n]) + HEAD_BYTES).reshape(width, LANES) for n in own]
        )
        lanes = np.zeros((len(own), BLOCK // LANES, LANES), np.uint64)
        mask = np.uint64((1 << width) - 1)
        for row in range(BLOCK // LANES if width else 0):
            word, shift = divmod(row * width, 64)
            value = words[:, word] >> np.uint64(shift)
            if shift + width > 64:
                value = value | words[:, word + 1] << np.uint64(64 - shift)
            lanes[:, row] = value & mask
        out[own] = lanes.reshape(len(own), BLOCK)
    for n, (width, low, odd) in enumerate(heads):
        at = int(starts[n]) + HEAD_BYTES + width * LANES * 8
        out[n, np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return (out + np.array([h[1] for h in heads], np.uint32)[:, None]).reshape(-1)


def filesystem(uri: str):
    """The file system of a shared folder and the path in it."""
    import pyarrow.fs as pafs

    # Hadoop's names of a store's connector; Arrow knows the store by one name.
    scheme, mark, rest = uri.partition("://")
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest)


class FileWriter:
    """Writes one file; ids may come in any portions."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.rest = np.zeros(0, np.uint32)
        self.starts: list[int] = []
        self.docs: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.ids = 0

    def add(self, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False))
        self.known.append(pc.is_valid(doc_ids).to_numpy(zero_copy_only=False))
        self.counts.append(counts)
        self.ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._put(ids[:whole])
        self.rest = ids[whole:]

    def _put(self, ids: np.ndarray) -> None:
        for low in range(0, len(ids), CHUNK * BLOCK):
            for block in encode_blocks(ids[low : low + CHUNK * BLOCK]):
                self.starts.append(self.at)
                self.stream.write(block)
                self.at += len(block)

    def close(self) -> None:
        self._put(self.rest)
        docs, counts = np.concatenate(self.docs), np.concatenate(self.counts)
        for column in (np.array(self.starts, "<i8"), docs.astype("<i8"), counts.astype("<i8")):
            self.stream.write(column.tobytes())
        self.stream.write(np.packbits(np.concatenate(self.known)).tobytes())
        self.stream.write(struct.pack(FOOT, len(self.starts), len(docs), self.ids))


def write_ids(docs: DataFrame, path: str, folder: str, *, end_id: int = 1) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) into files below ``folder`` in ascending doc_id order.

    Returns the stored list of files: file, part (their order), n_docs, n_ids.
    Texts are shuffled once, by range of doc_id. Null texts have only the end
    id; rows with equal doc_id follow each other in order of their text, those
    without one come first. A repeated task writes a new file, and the list names
    the file of the attempt that succeeded.
    """
    schema = pa.schema([("file", pa.string()), ("part", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        writer = None
        for piece in arrow.slices(batches, "text"):
            if writer is None:
                fs, root = filesystem(folder)
                fs.create_dir(root, recursive=True)
                name = f"part-{part:05d}-{uuid.uuid4().hex}.pfor"
                writer = FileWriter(fs.open_output_stream(f"{root}/{name}"))
            ids, counts = tokenizer(path).encode(piece.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            writer.add(piece.column("doc_id"), counts + 1, ids)
        if writer is not None:
            writer.close()
            writer.stream.close()
            yield arrow.batch(schema, [f"{folder}/{name}"], [part], [sum(map(len, writer.docs))], [writer.ids])

    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    listed = ordered.mapInArrow(write, "file string, part bigint, n_docs bigint, n_ids bigint")
    return materialize(listed, "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """Every document of listed ``files``: doc_id, start, n_tokens, ids (binary of uint32, little-endian)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = filesystem(row["file"])
                with fs.open_input_file(at) as file:
                    yield from documents(file, int(row["base"] or 0))

    def documents(file, base: int) -> Iterator[pa.RecordBatch]:
        size = file.size()
        blocks, docs, _ = struct.unpack(FOOT, file.read_at(FOOT_BYTES, size - FOOT_BYTES))
        bits = -(-docs // 8)
        tail = file.read_at(8 * (blocks + 2 * docs) + bits, size - FOOT_BYTES - 8 * (blocks + 2 * docs) - bits)
        numbers = np.frombuffer(tail, "<i8", blocks + 2 * docs)
        missing = np.unpackbits(np.frombuffer(tail, np.uint8, bits, len(tail) - bits), count=docs) == 0
        starts, doc_ids, counts = numbers[:blocks], numbers[blocks : blocks + docs], numbers[blocks + docs :]
        edges = np.append(starts, size - FOOT_BYTES - len(tail))
        ends = np.cumsum(counts)
        rest, done, seen = np.zeros(0, np.uint32), 0, 0
        for low in range(0, blocks, CHUNK):
            high = min(low + CHUNK, blocks)
            data = file.read_at(int(edges[high] - edges[low]), int(edges[low]))
            rest = np.concatenate([rest, decode_blocks(data, starts[low:high] - edges[low])])
            ready = int(np.searchsorted(ends, seen + len(rest), side="right"))
            if ready > done:
                used = int(ends[ready - 1]) - seen
                own = counts[done:ready]
                yield arrow.batch(
                    schema, pa.array(doc_ids[done:ready], mask=missing[done:ready]), base + ends[done:ready] - own, own,
                    arrow.binaries(rest[:used].astype("<u4"), np.cumsum(own)),
                )
                rest, seen, done = rest[used:], seen + used, ready

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.sum("n_ids").over(before))
    tasks = max(1, files.count())
    return placed.repartition(tasks, "file").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def roundtrip(docs: DataFrame, path: str, *, end_id: int = 1) -> DataFrame:
    """Write all documents to files in the shared folder and read them back (see write_ids, read_ids)."""
    folder = run_dir(docs.sparkSession, "token-ids")
    return read_ids(write_ids(docs, path, folder, end_id=end_id))


