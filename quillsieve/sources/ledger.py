"""Append-only progress ledger: which keys of which kind are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

SCHEMA = "kind string, key string, tokens bigint"


def record(df: DataFrame, path: str, kind: str, key: str, tokens: str | None = None) -> None:
    """Commit the distinct keys of ``df`` as done, with their token totals."""
    total = F.sum(tokens).cast("bigint") if tokens else F.lit(None).cast("bigint")
    done = df.groupBy(F.col(key).cast("string").alias("key")).agg(total.alias("tokens"))
    done.select(F.lit(kind).alias("kind"), "key", "tokens").write.mode("append").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)


def outstanding(df: DataFrame, ledger: DataFrame, kind: str, key: str) -> DataFrame:
    """Rows whose key the ledger does not list."""
    done = ledger.where(F.col("kind") == kind).select(F.col("key").alias("_done"))
    return df.join(done, F.col(key).cast("string") == F.col("_done"), "left_anti")


def progress(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("kind").agg(
        F.countDistinct("key").alias("keys"), F.sum("tokens").cast("bigint").alias("tokens")
    )
