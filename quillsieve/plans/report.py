"""Corpus report over a folder of shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.reporting import shard_label
from ..functions.textnorm import pattern_tokens
from ..operators.stats import corpus_report, shard_stats, token_estimate
from ..sources.shards import footers, scan_shards, shard_files


def footer_groups(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    facts = footers(shard_files(spark, path, glob))
    return facts.select(shard_label(F.col("path")).alias("name"), F.size("group_rows").alias("row_groups"))


def report_json(
    spark: SparkSession,
    path: str,
    glob: str = "*.parquet",
    tokens: Callable[[Column], Column] = pattern_tokens,
) -> DataFrame:
    """One row, one JSON document. Shard texts carry no id: the sample is keyed by file and row, so copies are drawn one by one."""
    docs = scan_shards(spark, path, glob, row_index=True)
    stats = shard_stats(docs, footer_groups(spark, path, glob))
    keyed = docs.select(F.concat_ws(":", "name", "row_index").alias("doc_id"), "text")
    return corpus_report(stats, token_estimate(keyed, tokens=tokens))
