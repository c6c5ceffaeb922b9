"""Corpus audit: counts, reject log, shards to rewrite, work still to do."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.matching import blocked, first_phrase, first_term, has_phrase
from ..functions.patterns import DEFAULT_PHRASES, TermList
from ..runtime import spread
from .packing import ROW_GROUP_ROWS, padded_rows


def term_table(df: DataFrame) -> DataFrame:
    """Distinct terms ignoring case; the first in list order wins."""
    return (
        df.groupBy(F.lower("term").alias("term"))
        .agg(
            F.min("ord").alias("ord"),
            F.min_by("category", "ord").alias("category"),
            F.min_by("whole_word", "ord").alias("whole_word"),
        )
        .where(F.length("term") > 0)
        .select("ord", "term", "category", "whole_word")
    )


def mark_blocked(df: DataFrame, terms: TermList, text: str = "text") -> DataFrame:
    return spread(df).withColumn("blocked", blocked(F.col(text), terms))


def screen(
    df: DataFrame,
    terms: TermList,
    phrases: Iterable[str] = (),
    text: str = "text",
) -> DataFrame:
    """Add ``stage``: "blocklist", "phrase", or null for a clean document."""
    stage = F.when(blocked(F.col(text), terms), "blocklist").when(
        has_phrase(F.col(text), phrases), "phrase"
    )
    return spread(df).withColumn("stage", stage)


def evidence(
    screened: DataFrame,
    terms: TermList,
    phrases: Iterable[str] = (),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rejected documents of ``screen`` with the term or phrase that caught them."""
    rejected = screened.where(F.col("stage").isNotNull()).select(
        key,
        "stage",
        first_term(F.col(text), terms).alias("_term"),
        first_phrase(F.col(text), phrases).alias("_phrase"),
    )
    matched = F.coalesce("_term", "_phrase")
    return rejected.select(key, "stage", matched.alias("matched"))


def audit_counts(marked: DataFrame, shard: str = "shard") -> DataFrame:
    """Per-shard total, removed, kept and written rows (mark_blocked output).

    One map-side aggregation; only one row per shard is shuffled.
    """
    counts = marked.groupBy(shard).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("blocked").alias("removed")
    )
    kept = F.col("total") - F.col("removed")
    return counts.withColumn("kept", kept).withColumn("written", padded_rows(F.col("kept")))


def audit_summary(
    df: DataFrame, terms: TermList, shard: str = "shard", text: str = "text"
) -> DataFrame:
    """Audit counts with a grand-total row (null shard).

    The rollup runs on the per-shard counts, so documents are not doubled.
    """
    counts = audit_counts(mark_blocked(df.select(shard, text), terms, text), shard)
    measures = [F.sum(name).alias(name) for name in ("total", "removed", "kept", "written")]
    return counts.rollup(shard).agg(*measures)


def dirty_shards(
    df: DataFrame,
    phrases: Iterable[str] = DEFAULT_PHRASES,
    shard: str = "shard",
    text: str = "text",
) -> DataFrame:
    """Shards the phrase pass changes, with their removed and kept rows."""
    hits = spread(df.select(shard, text)).select(shard, has_phrase(F.col(text), phrases).alias("_hit"))
    counts = hits.groupBy(shard).agg(
        F.count_if("_hit").alias("removed"), F.count_if(~F.col("_hit")).alias("kept")
    )
    return counts.where(F.col("removed") > 0)


def audit_log(
    df: DataFrame,
    terms: TermList,
    phrases: Iterable[str] = DEFAULT_PHRASES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rejected documents with the pass that caught them and the evidence."""
    phrases = list(phrases)
    screened = screen(df.select(key, text), terms, phrases, text)
    return evidence(screened, terms, phrases, key, text)


__all__ = [
    "ROW_GROUP_ROWS",
    "audit_counts",
    "audit_log",
    "audit_summary",
    "dirty_shards",
    "evidence",
    "mark_blocked",
    "screen",
    "term_table",
]
