"""Corpus build: select, budget, merge, shuffle, pack, pad; resumed after a stop, or appended to."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.ordering import SHUFFLE_SEED
from ..functions.textnorm import (
    MIN_BOOK_CHARS,
    long_enough,
    strip_boilerplate,
    token_count,
)
from ..operators.filters import DEFAULT_SUBSETS, audience_allowed
from ..operators.packing import ROW_GROUP_ROWS, SHARD_CHARS, pad_shards, plan_shards
from ..operators.selection import SOURCE_FRACTIONS, budget_cut, fraction_budgets, union_sources
from ..runtime import filesystem_of, materialize
from ..sources import manifest
from ..sources.shards import write_shards
from ..sources.stagestore import Stage, StageStore

# Default size of a corpus in tokens.
TARGET_TOKENS = 3_000_000_000


def select_educational(
    rows: DataFrame,
    budget: int,
    subsets: Mapping[str, Sequence[str] | None] = DEFAULT_SUBSETS,
) -> DataFrame:
    """``subset, ord, row_id, audience, text, text_token_length`` rows within the budget."""
    wanted = rows.where(
        audience_allowed(F.col("subset"), F.col("audience"), subsets) & long_enough(F.col("text"))
    ).withColumn("tokens", token_count(F.col("text"), F.col("text_token_length")))
    return budget_cut(wanted, budget).select(
        F.concat_ws(":", F.lit("e"), "ord", "row_id").alias("doc_id"), "text", "tokens"
    )


def clean_books(books: DataFrame) -> DataFrame:
    """``book_id, raw`` rows as row_id, text, tokens: stripped, and long enough."""
    text = strip_boilerplate(F.col("raw"))
    cleaned = books.select(F.col("book_id").alias("row_id"), text.alias("text"))
    return cleaned.where(long_enough(F.col("text"), MIN_BOOK_CHARS)).withColumn("tokens", token_count(F.col("text")))


def cut_books(cleaned: DataFrame, budget: int) -> DataFrame:
    """Stored clean_books rows in id order within the budget."""
    return budget_cut(cleaned.withColumn("ord", F.lit(0)), budget).select(
        F.concat_ws(":", F.lit("b"), "row_id").alias("doc_id"), "text", "tokens"
    )


def select_books(books: DataFrame, budget: int) -> DataFrame:
    """``book_id, raw`` rows: stripped, long enough, in id order within the budget.

    Stripped texts are stored once, so later passes do not repeat the cutting.
    """
    return cut_books(materialize(clean_books(books), "books"), budget)


def build_corpus(
    educational: DataFrame,
    books: DataFrame,
    target_tokens: int = TARGET_TOKENS,
    fractions: Mapping[str, float] = SOURCE_FRACTIONS,
    subsets: Mapping[str, Sequence[str] | None] = DEFAULT_SUBSETS,
    shard_chars: int = SHARD_CHARS,
    group_rows: int = ROW_GROUP_ROWS,
    seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """``doc_id, text, tokens, chars, shuffle_key, shard, copy, is_pad``.

    The selected texts are stored once with their lengths. Packing then reads
    keys and lengths only, and the texts are shuffled a single time, by shard:
    write the result with ``write_shards(..., clustered=True)``.
    """
    budgets = fraction_budgets(target_tokens, fractions)
    merged = union_sources(
        [
            select_educational(educational, budgets["educational"], subsets),
            select_books(books, budgets["books"]),
        ]
    )
    selected = materialize(merged.withColumn("chars", F.length("text")), "selected")
    return packed_corpus(selected, shard_chars, group_rows, seed)


def packed_corpus(selected: DataFrame, shard_chars: int, group_rows: int, seed: int) -> DataFrame:
    """Stored ``selected`` rows (doc_id, text, chars, ...) in padded shards."""
    plan = plan_shards(selected, chars="chars", target=shard_chars, seed=seed)
    return pad_shards(
        plan.assign(selected), group_rows=group_rows, sizes=plan.sizes(), whole_shards=True
    )


@dataclass(frozen=True)
class Source:
    """A part of the corpus that is collected as one stage.

    ``key`` changes with the content (see stagestore.fingerprint); ``read`` is
    called only if the stage isn't stored yet.
    """

    name: str
    key: str
    read: Callable[[], DataFrame]


def collect_sources(
    store: StageStore,
    educational: Sequence[Source],
    books: Sequence[Source],
    target_tokens: int = TARGET_TOKENS,
    fractions: Mapping[str, float] = SOURCE_FRACTIONS,
    subsets: Mapping[str, Sequence[str] | None] = DEFAULT_SUBSETS,
) -> Stage:
    """The selected rows of a corpus (doc_id, text, tokens, chars), stage by stage; a restart goes on where it stopped.

    Each educational source is a stage with its running total; those after the
    one that reaches the budget are not read at all. Its rows are as for
    build_corpus, with ``ord`` ascending from source to source. Each source of
    books is a stage of stripped texts; the budget cuts their union in id order.
    The selection is a stage of its own.
    """
    budgets = fraction_budgets(target_tokens, fractions)
    left, parts = budgets["educational"], []
    for source in educational:
        if left <= 0:
            break
        stage = store.run(
            f"educational {source.name}", [source.key, left, {k: list(v or []) for k, v in subsets.items()}],
            lambda: select_educational(source.read(), left, subsets), tokens="tokens",
        )
        parts.append(stage)
        left -= stage.tokens
    shelves = [
        store.run(f"books {source.name}", [source.key, MIN_BOOK_CHARS], lambda: clean_books(source.read()), tokens="tokens")
        for source in books
    ]

    def select() -> DataFrame:
        rows = [stage.rows for stage in parts]
        if shelves:
            rows.append(cut_books(union_sources([stage.rows for stage in shelves]), budgets["books"]))
        return union_sources(rows).withColumn("chars", F.length("text"))

    return store.run("selected", [[s.key for s in parts], [s.key for s in shelves], budgets], select, tokens="tokens")


def resumable_corpus(
    store: StageStore,
    educational: Sequence[Source],
    books: Sequence[Source],
    target_tokens: int = TARGET_TOKENS,
    fractions: Mapping[str, float] = SOURCE_FRACTIONS,
    subsets: Mapping[str, Sequence[str] | None] = DEFAULT_SUBSETS,
    shard_chars: int = SHARD_CHARS,
    group_rows: int = ROW_GROUP_ROWS,
    seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """As build_corpus, from the stages of collect_sources; the padded shards are the last stage."""
    selected = collect_sources(store, educational, books, target_tokens, fractions, subsets)
    stage = store.run(
        "shards", [selected.key, shard_chars, group_rows, seed],
        lambda: packed_corpus(selected.rows, shard_chars, group_rows, seed),
    )
    return stage.rows


def append_corpus(
    spark: SparkSession,
    root: str,
    docs: DataFrame,
    batch: str,
    shard_chars: int = SHARD_CHARS,
    group_rows: int = ROW_GROUP_ROWS,
    seed: int = SHUFFLE_SEED,
) -> int:
    """Pack ``docs`` (doc_id, text) behind what the shard folder ``root`` holds; returns the new version.

    The seeded order of the new documents follows the old ones: the last shard,
    if its own rows have fewer than ``shard_chars`` characters, takes up the
    first of them and is published anew with fresh padding; the others stay as
    they are. All becomes visible at once, and only once for each ``batch`` name,
    so a run that died is simply repeated. The folder's files must flag their pad
    rows (is_pad).
    """
    docs = materialize(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), "appended")
    first, old = _open_shard(spark, root, shard_chars)
    carry, kept = 0, 0
    if old is not None:
        old = materialize(old, "open-shard")
        kept, carry = old.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
        if carry >= shard_chars:
            first, old, carry, kept = first + 1, None, 0, 0
    if docs.isEmpty():
        return (manifest.versions(spark, root) or [0])[-1]
    plan = plan_shards(docs, target=shard_chars, seed=seed, first_shard=first, carry=carry)
    placed = plan.assign(docs).select(
        "shard", "doc_id", "text", F.concat(F.lit("1:"), "shuffle_key").alias("order")
    )
    sizes = plan.sizes()
    if old is not None:
        placed = placed.unionByName(old.withColumn("shard", F.lit(first).cast("bigint")))
        more = spark.createDataFrame([(first, kept)], "shard bigint, n bigint")
        sizes = sizes.unionByName(more).groupBy("shard").agg(F.sum("n").alias("n"))
    rows = pad_shards(placed, order="order", group_rows=group_rows, sizes=sizes, whole_shards=True)

    def write(rows: DataFrame, folder: str) -> None:
        write_shards(rows, folder, order="order", group_rows=group_rows, clustered=True, extra=("is_pad",))

    touched = spark.createDataFrame([(first,)] if old is not None else [], "shard bigint")
    return manifest.replace_shards(spark, root, rows, touched, write, batch)


def _open_shard(spark: SparkSession, root: str, shard_chars: int) -> tuple[int, DataFrame | None]:
    """The last shard's number and its own rows (doc_id, text, order), or the number to begin with and None."""
    filesystem, path = filesystem_of(spark, root)
    if not filesystem.exists(path):
        return 0, None
    last = manifest.shards_at(spark, root).orderBy(F.desc("shard")).first()
    if last is None:
        return 0, None
    if not last.files:
        return last.shard + 1, None
    rows = spark.read.schema("text string, is_pad boolean").parquet(*(f"{root.rstrip('/')}/{f}" for f in last.files))
    place = F.format_string("0:%s:%020d", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    # A file without the flag is refused: its pads could not be told from its documents.
    flag = F.when(F.col("is_pad").isNull(), F.raise_error(F.lit("the last shard does not flag its pad rows")).cast("boolean"))
    own = rows.where(~flag.otherwise(F.col("is_pad")))
    return last.shard, own.select(place.alias("doc_id"), "text", place.alias("order"))
