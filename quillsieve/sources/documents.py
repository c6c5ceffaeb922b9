"""Readers and writers of raw documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..functions.textnorm import strip
from ..operators.selection import union_sources

SOURCE_SCHEMA = "text string, audience string, text_token_length bigint"


def scan_subsets(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema: str | StructType = SOURCE_SCHEMA,
    format: str = "parquet",
) -> tuple[DataFrame, dict[str, str]]:
    """Union of the subsets in mapping order, tagged ``subset`` and ``ord``.

    A subset that cannot be opened is skipped; its error is returned by name.
    """
    parts, failed = [], {}
    for position, (name, path) in enumerate(paths.items()):
        try:
            part = spark.read.schema(schema).format(format).load(path)
        except AnalysisException as error:
            failed[name] = str(error)
            continue
        parts.append(part.withColumn("subset", F.lit(name)).withColumn("ord", F.lit(position)))
    if not parts:
        raise ValueError(f"no subset could be opened: {failed}")
    return union_sources(parts), failed


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType = "text string") -> DataFrame:
    return spark.read.schema(schema).json(path)


def count_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank."""
    lines = spark.read.text(path)
    return lines.agg(F.count_if(F.length(strip(F.col("value"))) > 0).alias("lines"))


def append_jsonl(df: DataFrame, path: str, *columns: str) -> None:
    df.select(*(columns or ("text",))).write.mode("append").json(path)


def append_dialogues(df: DataFrame, path: str, messages: str = "messages") -> None:
    """One JSON array per line; ``messages`` is nested or already JSON."""
    nested = dict(df.dtypes)[messages] != "string"
    value = F.to_json(messages) if nested else F.col(messages)
    df.select(value.alias("value")).write.mode("append").text(path)


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """``book_id, raw`` of the ``pg<id>.txt`` files below ``path``, one document per file."""
    files = spark.read.option("pathGlobFilter", "pg*.txt").text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^pg(\d+)\.txt$", 1)
    return files.select(name.cast("bigint").alias("book_id"), F.col("value").alias("raw"))
