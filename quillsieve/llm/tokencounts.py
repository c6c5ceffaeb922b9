"""Token counts of documents in flat token files that have no index.

A file is nothing but ids; each document ends with a separator id. Files are cut
into blocks of fixed size, which are scanned in parallel. A prefix scan over the
block summaries (separators, end of the last one) tells each block how many
documents end before it and where its first document began. The scan has two
levels, so a file of any length is spread over tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillsieve.llm import arrow
from quillsieve.llm.idfiles import filesystem
from quillsieve.llm.tokens import tokenizer
from quillsieve.runtime import materialize

BLOCK_IDS = 1 << 20
# Blocks whose summaries are scanned together.
RUN_BLOCKS = 4096


def write_flat(docs: DataFrame, path: str, folder: str, *, separator: int, dtype: str = "<u2") -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) into flat files: one for each task, in the order of its rows.

    Returns a stored table file, n_ids, doc_ids: the rows of each file in order,
    in portions (``first`` is the number of the portion's first document).
    """
    top = np.iinfo(np.dtype(dtype)).max
    if separator > top:
        raise ValueError(f"separator {separator} does not fit {dtype}")
    schema = pa.schema([("file", pa.string()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, first = None, 0
        for part in arrow.slices(batches, "text"):
            if stream is None:
                fs, root = filesystem(folder)
                fs.create_dir(root, recursive=True)
                name = f"{uuid.uuid4().hex}.bin"
                stream = fs.open_output_stream(f"{root}/{name}")
            ids, counts = tokenizer(path).encode(part.column("text"))
            if len(ids) and ids.max() > top:
                raise ValueError(f"an id does not fit {dtype}")
            if (ids == separator).any():
                raise ValueError(f"separator {separator} occurs in a text")
            ids = np.insert(ids, np.cumsum(counts), separator)
            stream.write(ids.astype(dtype).tobytes())
            rows = part.column("doc_id").cast(pa.int64()).to_pylist()
            yield arrow.batch(schema, [f"{folder}/{name}"], [first], [len(ids)], pa.array([rows], schema.field("doc_ids").type))
            first += len(rows)
        if stream is not None:
            stream.close()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return materialize(rows.mapInArrow(write, "file string, first bigint, n_ids bigint, doc_ids array<bigint>"), "flat-ids")


def count_tokens(
    files: DataFrame, *, separator: int, dtype: str = "<u2", block_ids: int = BLOCK_IDS, run_blocks: int = RUN_BLOCKS
) -> DataFrame:
    """Documents in flat ``files`` (file, n_ids): file, ordinal, start, n_tokens, terminated.

    n_tokens counts the separator. Ids after the last separator are a document
    with ``terminated`` false. Consecutive separators are documents of one
    token; a file without ids has no documents.
    """
    width = np.dtype(dtype).itemsize
    blocks = (
        files.where(F.col("n_ids") > 0)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_ids - 1) div {block_ids}"))))
        .select("file", "n_ids", "block")
    )
    # One task for about 64 MB; the summaries and the list of blocks are small tables.
    tasks = max(1, -(-blocks.count() * block_ids * width // (64 << 20)), files.sparkSession.sparkContext.defaultParallelism)
    blocks = blocks.repartition(tasks, "file", "block")

    def ends_of(row: dict) -> np.ndarray:
        first = row["block"] * block_ids
        count = min(block_ids, row["n_ids"] - first)
        fs, at = filesystem(row["file"])
        with fs.open_input_file(at) as file:
            ids = np.frombuffer(file.read_at(count * width, first * width), dtype)
        if len(ids) != count:
            raise ValueError(f"{row['file']} is shorter than {row['n_ids']} ids")
        return first + 1 + np.flatnonzero(ids == separator)

    summary = pa.schema(
        [("file", pa.string()), ("n_ids", pa.int64()), ("block", pa.int64()), ("ends", pa.int64()), ("last", pa.int64())]
    )

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = ends_of(row)
                last = int(ends[-1]) if len(ends) else 0
                yield arrow.batch(summary, [row["file"]], [row["n_ids"]], [row["block"]], [len(ends)], [last])

    found = materialize(
        blocks.mapInArrow(summarise, "file string, n_ids bigint, block bigint, ends bigint, last bigint"), "block-ends"
    ).withColumn("run", F.expr(f"block div {run_blocks}"))
    within = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = found.groupBy("file", "run").agg(F.sum("ends").alias("ends"), F.max("last").alias("last"))
    zero = F.lit(0).cast("bigint")
    carried = runs.select(
        "file", "run",
        F.coalesce(F.sum("ends").over(across), zero).alias("run_ordinal"),
        F.coalesce(F.max("last").over(across), zero).alias("run_start"),
    )
    # Merged: the windows need the same exchange, and no table that grows with the files goes through the driver.
    placed = found.hint("merge").join(carried, ["file", "run"]).select(
        "file", "n_ids", "block",
        (F.col("run_ordinal") + F.coalesce(F.sum("ends").over(within), zero)).alias("ordinal"),
        F.greatest("run_start", F.coalesce(F.max("last").over(within), zero)).alias("start"),
    )
    result = pa.schema(
        [("file", pa.string()), ("ordinal", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("terminated", pa.bool_())]
    )

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = ends_of(row)
                done = np.ones(len(ends), bool)
                if (row["block"] + 1) * block_ids >= row["n_ids"] and (ends[-1] if len(ends) else row["start"]) < row["n_ids"]:
                    ends, done = np.append(ends, row["n_ids"]), np.append(done, False)
                starts = np.concatenate([[row["start"]], ends[:-1]]) if len(ends) else ends
                yield arrow.batch(
                    result, [row["file"]] * len(ends), row["ordinal"] + np.arange(len(ends)), starts, ends - starts, done
                )

    return placed.repartition(tasks, "file", "block").mapInArrow(
        stitch, "file string, ordinal bigint, start bigint, n_tokens bigint, terminated boolean"
    )


def with_doc_ids(counts: DataFrame, written: DataFrame) -> DataFrame:
    """Name the documents of files made by write_flat.

    Both sides have a row for each document, but come out of few rows (blocks,
    portions) whose size Spark takes for theirs; so they are merged, not broadcast.
    """
    names = written.select("file", "first", F.posexplode("doc_ids").alias("place", "doc_id")).select(
        "file", (F.col("first") + F.col("place")).alias("ordinal"), "doc_id"
    )
    # Ordinals first: they sort faster than paths that begin alike.
    return counts.hint("merge").join(names, ["ordinal", "file"]).select(*counts.columns, "doc_id")
