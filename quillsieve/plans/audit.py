"""Corpus audit: screen shards, log rejects, repack the survivors."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.ordering import shuffle_key
from ..functions.matching import first_phrase, has_phrase
from ..functions.patterns import DEFAULT_PHRASES, TermList
from ..functions.reporting import shard_number
from ..operators import termindex
from ..operators.audit import audit_counts, dirty_shards, evidence, screen
from ..operators.packing import ROW_GROUP_ROWS, pad_shards
from ..runtime import broadcast_within, materialize
from ..sources import manifest
from ..sources.shards import write_shards


@dataclass(frozen=True)
class AuditResult:
    """Lazy outputs of one audit; each is computed when written or read."""

    kept: DataFrame
    counts: DataFrame
    log: DataFrame


def audit_corpus(
    docs: DataFrame,
    terms: TermList | DataFrame,
    phrases: Iterable[str] = (),
    shard: str = "shard",
    row_id: str = "doc_id",
    text: str = "text",
    group_rows: int = ROW_GROUP_ROWS,
    whole_shards: bool = False,
) -> AuditResult:
    """Screen ``docs`` in one pass; ``phrases`` adds the second pass to the same scan.

    Matching costs far more than storing, so the screened rows are written once
    and counts, log and repacking read them back: counts without the texts, the
    log only the rejected rows. Pad copies of an earlier run are dropped first
    and the survivors padded anew (``whole_shards`` as in pad_shards). ``terms``
    may be a table of any size (ord, term, category, whole_word); ``row_id`` must
    then be unique.
    """
    phrases = list(phrases)
    if "is_pad" in docs.columns:
        docs = docs.where(~F.col("is_pad")).drop("is_pad", "copy")
    if isinstance(terms, DataFrame):
        named = termindex.with_first_term(docs, terms, row_id, text, "_term")
        stage = F.when(F.col("_term").isNotNull(), "blocklist").when(has_phrase(F.col(text), phrases), "phrase")
        screened = materialize(named.withColumn("stage", stage), "screened")
        rejected = screened.where(F.col("stage").isNotNull())
        matched = F.coalesce("_term", first_phrase(F.col(text), phrases))
        log = rejected.select(row_id, "stage", matched.alias("matched"))
        screened = screened.drop("_term")
    else:
        screened = materialize(screen(docs, terms, phrases, text), "screened")
        log = evidence(screened, terms, phrases, row_id, text)
    counts = audit_counts(screened.withColumn("blocked", F.col("stage").isNotNull()), shard)
    kept = screened.where(F.col("stage").isNull()).drop("stage")
    if "shuffle_key" not in kept.columns:
        kept = kept.withColumn("shuffle_key", shuffle_key(F.col(row_id)))
    sizes = counts.where(F.col("kept") > 0).select(shard, F.col("kept").alias("n"))
    return AuditResult(
        kept=pad_shards(
            kept, shard, row_id, group_rows=group_rows, sizes=sizes, whole_shards=whole_shards
        ),
        counts=counts,
        log=log,
    )


def rewrite_dirty(
    docs: DataFrame,
    phrases: Iterable[str] = DEFAULT_PHRASES,
    shard: str = "shard",
    row_id: str = "doc_id",
    text: str = "text",
    group_rows: int = ROW_GROUP_ROWS,
    whole_shards: bool = False,
    dirty: DataFrame | None = None,
) -> DataFrame:
    """The padded replacement rows of the shards that lose a document; others are left alone.

    ``dirty`` is the stored result of dirty_shards, if it is known already.
    """
    phrases = list(phrases)
    if dirty is None:
        dirty = materialize(dirty_shards(docs, phrases, shard, text), "dirty")
    survivors = docs.where(~has_phrase(F.col(text), phrases)).join(
        broadcast_within(dirty.select(shard), dirty.count()), shard, "left_semi"
    )
    if "shuffle_key" not in survivors.columns:
        survivors = survivors.withColumn("shuffle_key", shuffle_key(F.col(row_id)))
    sizes = dirty.where(F.col("kept") > 0).select(shard, F.col("kept").alias("n"))
    return pad_shards(
        survivors, shard, row_id, group_rows=group_rows, sizes=sizes, whole_shards=whole_shards
    )


def rewrite_live(
    spark: SparkSession,
    root: str,
    phrases: Iterable[str] = DEFAULT_PHRASES,
    group_rows: int = ROW_GROUP_ROWS,
    pad_flag: bool = False,
) -> tuple[int | None, DataFrame]:
    """Second pass over a corpus folder, published as its next version.

    Returns the version (None if no shard changes) and the changed shards with
    removed and kept rows. A shard that loses all its documents is empty from
    then on; files side by side are replaced like ``shard=N`` folders.
    """
    phrases = list(phrases)
    docs = live_rows(spark, root)
    dirty = materialize(dirty_shards(docs, phrases), "dirty")
    if dirty.isEmpty():
        return None, dirty
    changed = rewrite_dirty(docs, phrases, group_rows=group_rows, whole_shards=True, dirty=dirty)
    extra = ("is_pad",) if pad_flag else ()

    def write(rows: DataFrame, folder: str) -> None:
        write_shards(rows, folder, group_rows=group_rows, clustered=True, extra=extra)

    return manifest.replace_shards(spark, root, changed, dirty.select("shard"), write), dirty


def live_rows(spark: SparkSession, root: str) -> DataFrame:
    """shard, text, doc_id of a corpus folder's live rows without flagged pad copies; file and position name a row."""
    rows = manifest.scan(spark, root, "text string, is_pad boolean")
    rows = rows.where(~F.coalesce("is_pad", F.lit(False)))
    file = F.col("_metadata.file_path")
    position = F.concat_ws(":", file, F.col("_metadata.row_index"))
    return rows.select(shard_number(file).alias("shard"), "text", F.md5(position).alias("doc_id"))
