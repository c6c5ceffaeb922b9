"""Verdict gate over two streams: documents wait for their verdicts, for a while."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.filters import is_safe_verdict

LATENESS = "1 minute"
PATIENCE = "10 minutes"


def gate_stream(
    docs: DataFrame,
    verdicts: DataFrame,
    key: str,
    time: str = "time",
    verdict: str = "verdict",
    patience: str = PATIENCE,
    lateness: str = LATENESS,
) -> DataFrame:
    """Decided documents and verdicts that came too late, as one stream.

    A document (``key``, ``time``, others) whose verdict has a time from its own
    to ``patience`` later is decided by it; the first verdict of a key counts. One
    without comes out unsafe as soon as both streams have passed that time
    (fail-closed). A verdict that meets no document, being late or for a key
    nobody asked about, comes out with the document's columns null and
    ``late_key`` and ``late_verdict`` set. Rows that trail their stream by more
    than ``lateness`` are dropped by Spark, and their documents never released.
    Rows without key move the clock only: send one on either side when it falls
    silent.
    """
    left = docs.withWatermark(time, lateness)
    right = verdicts.select(F.col(key).alias("late_key"), F.col(time).alias("_at"), F.col(verdict).alias("late_verdict"))
    right = right.withWatermark("_at", lateness).dropDuplicatesWithinWatermark(["late_key"])
    within = F.expr(f"`{key}` = late_key AND _at >= `{time}` AND _at <= `{time}` + INTERVAL {patience}")
    met = left.join(right, within, "fullOuter")
    known = F.col(key).isNotNull()
    return met.where(known | F.col("late_key").isNotNull()).select(
        *docs.columns,
        F.when(known, is_safe_verdict(F.col("late_verdict"))).alias("is_safe"),
        F.when(~known, F.col("late_key")).alias("late_key"),
        F.when(~known, F.col("late_verdict")).alias("late_verdict"),
    )


def run_gate(gated: DataFrame, output: str, checkpoint: str) -> None:
    """Process what is there and stop; decisions and late verdicts are appended below ``output``, each batch once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch={batch_id:09d}"
        stored = batch.persist()
        try:
            decided = stored.where(F.col("is_safe").isNotNull()).drop("late_key", "late_verdict")
            decided.write.mode("overwrite").parquet(f"{output}/decided/{folder}")
            late = stored.where(F.col("is_safe").isNull()).select("late_key", "late_verdict")
            late.write.mode("overwrite").parquet(f"{output}/late/{folder}")
        finally:
            stored.unpersist()

    query = (
        gated.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def decisions(spark: SparkSession, output: str, schema: str) -> DataFrame:
    """All decided documents so far; ``schema`` are the documents' columns."""
    return spark.read.schema(f"{schema}, is_safe boolean, batch bigint").parquet(f"{output}/decided").drop("batch")


def late_verdicts(spark: SparkSession, output: str, key_type: str = "bigint") -> DataFrame:
    """The log of verdicts that decided nothing."""
    schema = f"late_key {key_type}, late_verdict string, batch bigint"
    return spark.read.schema(schema).parquet(f"{output}/late").drop("batch")
