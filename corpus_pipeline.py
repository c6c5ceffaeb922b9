"""From raw documents to packed training windows, in five stages.

Every stage works on all rows its predecessor kept. The first four keep or drop
documents, or shorten their text, and return the columns of ``documents``; the
last returns the pieces of packed windows. Between stages the rows are stored as
Parquet, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillsieve.llm import decontam, minhash, packing, quality, substring
from quillsieve.llm.tokens import vocabulary
from quillsieve.runtime import materialize

# SQL cannot express the trained classifier or the tokenizer.
ORACLE_SQL = None


def _fresh(name: str) -> str:
    """A column name that no table has."""
    return f"{name}_{uuid.uuid4().hex}"


def _numbered(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a number of each row in ``key``; stored, so that it stays the row's own."""
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")


def _texts(numbered: DataFrame, key: str) -> DataFrame:
    """The rows' texts, with the row number as doc_id."""
    return numbered.select(F.col(key).alias("doc_id"), "text")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.3); empty texts are rejected."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.learn(docs, labels)
    score = _fresh("score")
    return quality.score(docs, model, out=score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of near duplicates, and all that are in none.

    Rows are told apart by their place, so rows with equal or no doc_id count one by one;
    one without comes after those with one.
    """
    key = _fresh("row")
    numbered = _numbered(docs, key)
    groups = minhash.near_duplicates(_texts(numbered, key)).select(F.col("doc_id").alias(key), "component_id")
    placed = numbered.select(key, "doc_id").join(groups, key)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    kept = placed.groupBy("component_id").agg(F.min_by(key, order).alias(key))
    return numbered.join(kept.select(key), key, "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat a document with a smaller doc_id are cut; other texts stay as they are.

    A text that loses words becomes its remaining words, joined by one space; if
    all go, it becomes empty. n_chars follows the text.
    """
    words, removed, kept = map(_fresh, ("words", "removed", "kept"))
    cut = substring.remove_repeats(docs, names=(words, removed, kept))
    changed = cut.withColumn("text", F.when(F.col(removed) > 0, F.col(kept)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        changed = changed.withColumn("n_chars", F.when(F.col(removed) > 0, length).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without an overlap with a benchmark item, whatever their doc_id."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = _fresh("row")
    numbered = _numbered(docs, key)
    found = decontam.contamination(_texts(numbered, key), benchmark)
    hits = materialize(found.select(F.col("doc_id").alias(key)).distinct(), "hits")
    return numbered.join(hits, key, "left_anti").select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of windows of at most 2,048 tokens, with a checksum of each piece's ids."""
    pieces = packing.stored_pieces(docs, vocabulary("byte_bpe_50k.json"))
    return packing.pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed windows of the documents below ``sf_dir``; each stage is stored and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name)
    return rows


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
