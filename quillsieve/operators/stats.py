"""Corpus statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import whole_div
from ..functions.reporting import bar, mebibytes, range_label, shard_label
from ..functions.textnorm import CHARS_PER_TOKEN, pattern_tokens
from ..runtime import materialize
from .packing import sample_rows

# Documents tokenized for the estimate.
TOKEN_SAMPLE = 1000


def shard_stats(docs: DataFrame, row_groups: DataFrame | None = None) -> DataFrame:
    """Documents, characters and size per shard file.

    ``docs`` comes from scan_shards; the optional ``row_groups`` table comes
    from the footer reader.
    """
    per_file = docs.groupBy("path").agg(
        F.count(F.lit(1)).alias("docs"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("chars"),
        mebibytes(F.max("file_size")).alias("size_mb"),
    )
    stats = per_file.withColumn("path", shard_label(F.col("path"))).withColumnRenamed("path", "name")
    return stats if row_groups is None else stats.join(row_groups, "name", "left")


def corpus_totals(docs: DataFrame, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """Documents, characters, mean characters and mean tokens per document."""
    totals = docs.agg(
        F.count(F.lit(1)).alias("total_docs"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("total_chars"),
    )
    mean = F.col("total_chars") / F.greatest("total_docs", F.lit(1))
    return totals.withColumn("avg_chars", mean).withColumn(
        "avg_tokens", F.col("avg_chars") / chars_per_token
    )


def token_estimate(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    sample_size: int = TOKEN_SAMPLE,
    tokens: Callable[[Column], Column] = pattern_tokens,
) -> DataFrame:
    """Corpus token estimate from the character/token ratio of a seeded sample.

    ``tokens`` counts the tokens of a text column; a pandas UDF fits here.
    """
    sampled = sample_rows(docs.select(row_id, text), sample_size, row_id)
    ratio = sampled.agg(
        F.sum(F.length(text)).alias("sample_chars"), F.sum(tokens(F.col(text))).alias("sample_tokens")
    )
    totals = docs.agg(F.sum(F.length(text)).alias("total_chars"))
    # Two one-row frames become one by adding them up, not by a cross join.
    both = totals.unionByName(ratio, allowMissingColumns=True).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in
          ("total_chars", "sample_chars", "sample_tokens")]
    )
    empty = F.col("sample_chars") == 0
    cpt = F.when(empty, F.lit(CHARS_PER_TOKEN)).otherwise(
        F.try_divide(F.col("sample_chars"), F.col("sample_tokens"))
    )
    return both.withColumn("chars_per_token", cpt).withColumn(
        "estimated_tokens",
        F.when(empty, F.lit(0)).otherwise(F.try_divide("total_chars", "chars_per_token").cast("bigint")),
    )


def token_ratio(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    sample_size: int = TOKEN_SAMPLE,
    tokens: Callable[[Column], Column] = pattern_tokens,
) -> DataFrame:
    """Characters per token of a seeded sample with its standard error, in one pass over the corpus.

    The error is that of a ratio of sums: the spread of ``chars - ratio * tokens``
    over the sampled documents. It is null below two documents or without tokens.
    """
    sampled = sample_rows(docs.select(row_id, text), sample_size, row_id)
    each = sampled.select(F.coalesce(F.length(text), F.lit(0)).alias("c"), F.coalesce(tokens(F.col(text)), F.lit(0)).alias("t"))
    # Sums of squares and products of whole numbers are exact.
    whole = [F.sum(x.cast("decimal(38,0)")).alias(n) for n, x in (
        ("c", F.col("c")), ("t", F.col("t")), ("cc", F.col("c").cast("decimal(18,0)") * F.col("c").cast("decimal(18,0)")),
        ("ct", F.col("c").cast("decimal(18,0)") * F.col("t").cast("decimal(18,0)")), ("tt", F.col("t").cast("decimal(18,0)") * F.col("t").cast("decimal(18,0)")),
    )]
    sums = each.agg(F.count(F.lit(1)).alias("n"), *whole)
    n, c, t, cc, ct, tt = (F.col(x).cast("double") for x in ("n", "c", "t", "cc", "ct", "tt"))
    ratio = F.try_divide(c, t)
    spread = F.try_divide(F.greatest(cc - 2 * ratio * ct + ratio * ratio * tt, F.lit(0.0)), n * (n - 1))
    return sums.select(
        F.col("n").alias("sample_docs"), F.coalesce("c", F.lit(0)).cast("bigint").alias("sample_chars"),
        F.coalesce("t", F.lit(0)).cast("bigint").alias("sample_tokens"), ratio.alias("chars_per_token"),
        F.try_divide(F.sqrt(spread), t / n).alias("standard_error"),
    )


def length_histogram(docs: DataFrame, bins: int = 10, text: str = "text") -> DataFrame:
    """Equal-width histogram of lengths; empty bins stay, an empty corpus has none.

    The corpus is read once: everything works on the length frequencies.
    """
    lengths = materialize(
        docs.where(F.col(text).isNotNull())
        .groupBy(F.length(text).cast("bigint").alias("chars"))
        .agg(F.count(F.lit(1)).alias("n")),
        "lengths",
    )
    low, high, total = lengths.agg(F.min("chars"), F.max("chars"), F.sum("n")).first()
    spark = docs.sparkSession
    if total is None:
        low, high, total, bins = 0, 0, 0, 0
    width = max((high - low) // max(bins, 1), 1)
    slot = F.least(whole_div(F.col("chars") - low, width), F.lit(bins - 1))
    counts = lengths.groupBy(slot.cast("bigint").alias("bin")).agg(F.sum("n").alias("n"))
    lo = F.lit(low) + F.col("bin") * width
    hi = F.when(F.col("bin") < bins - 1, lo + width - 1).otherwise(F.lit(high))
    count = F.coalesce("n", F.lit(0)).cast("bigint")
    return (
        spark.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select("bin", range_label(lo, hi).alias("label"), count.alias("docs"))
        .withColumn("bar", bar(F.col("docs"), F.lit(total)))
    )


def corpus_report(stats: DataFrame, estimate: DataFrame) -> DataFrame:
    """One JSON document: totals, means, and one entry per shard, in name order; the last is for validation.

    ``stats`` has one row per shard file, which bounds the collected array.
    """
    shard = F.struct("name", "docs", "chars", "size_mb", "row_groups")
    totals = stats.agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("total_docs"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("total_chars"),
        F.count(F.lit(1)).alias("num_shards"),
        F.array_sort(F.collect_list(shard)).alias("shards"),
    )
    parts = totals.unionByName(
        estimate.select("estimated_tokens", "chars_per_token"), allowMissingColumns=True
    ).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in
          ("total_docs", "total_chars", "estimated_tokens", "chars_per_token", "num_shards")],
        (F.max("total_chars") / F.greatest(F.max("total_docs"), F.lit(1))).alias("avg_doc_length_chars"),
        F.first("shards", ignorenulls=True).alias("shards"),
    )
    mean_tokens = F.try_divide("avg_doc_length_chars", "chars_per_token")
    last = F.try_element_at("shards", F.lit(-1))
    validation = F.when(last.isNotNull(), F.struct(*[last[c].alias(c) for c in ("name", "docs", "chars")]))
    parts = parts.withColumn("avg_doc_length_tokens", mean_tokens).withColumn("validation_shard", validation)
    return parts.select(F.to_json(F.struct("*")).alias("report"))
