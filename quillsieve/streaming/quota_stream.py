"""Accepted dialogues up to a target, over micro-batches of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.ordering import SHUFFLE_SEED
from ..operators.packing import sample_rows
from ..runtime import filesystem_of, materialize


def _committed(spark: SparkSession, output: str, before: int | None = None) -> list[str]:
    """Folders of finished batches, of those with a smaller number if ``before`` is given."""
    filesystem, path = filesystem_of(spark, output)
    if not filesystem.exists(path):
        return []
    numbered = []
    for status in filesystem.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("batch=") and (before is None or int(name[6:]) < before):
            if filesystem.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                numbered.append(f"{output}/{name}")
    return sorted(numbered)


def accepted_so_far(spark: SparkSession, output: str, schema: str, before: int | None = None) -> DataFrame:
    """Accepted rows of the finished batches."""
    folders = _committed(spark, output, before)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def accept_batch(batch: DataFrame, batch_id: int, output: str, target: int, key: str, schema: str, seed: int = SHUFFLE_SEED) -> int:
    """Store what of ``batch`` (good rows only) still fits the target; returns the total after it.

    What earlier batches hold is counted from their folders, so a replayed batch
    finds the same count and replaces its own folder only. A key that was
    accepted before, or comes twice, is taken once. If not all fit, the first in
    the seeded order of the batch do.
    """
    spark = batch.sparkSession
    earlier = accepted_so_far(spark, output, schema, before=batch_id)
    done = earlier.count()
    fresh = materialize(batch.dropDuplicates([key]).join(earlier.select(key), key, "left_anti"), "fresh")
    kept = sample_rows(fresh, target - done, key, seed) if done < target else fresh.limit(0)
    folder = f"{output}/batch={batch_id:09d}"
    kept.write.mode("overwrite").parquet(folder)
    return done + spark.read.schema(schema).parquet(folder).count()


def accept_stream(
    replies: DataFrame,
    screen: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    target: int,
    key: str = "task_id",
    schema: str = "task_id string, messages string",
) -> int:
    """Screen the ``replies`` that are there and accept up to ``target`` in all runs together; returns the total.

    ``screen`` turns a batch into its good rows. Once the target is reached the
    rest of the stream is only marked as read.
    """
    spark = replies.sparkSession
    names = [f.split()[0] for f in schema.split(", ")]

    def accept(batch: DataFrame, batch_id: int) -> None:
        accept_batch(screen(batch).select(*names), batch_id, output, target, key, schema)

    query = replies.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(accept).start()
    query.awaitTermination()
    return accepted_so_far(spark, output, schema).count()
