"""Seeded shuffle, greedy shard packing, padding, sampling and splitting."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ordering import (
    SAMPLE_SEED,
    SHUFFLE_SEED,
    bucket_digits,
    key_bucket,
    shuffle_key,
    whole_div,
)
from ..functions.textnorm import preview
from ..runtime import broadcast_within, materialize

# Characters per shard and rows per row group.
SHARD_CHARS = 250_000_000
ROW_GROUP_ROWS = 1024

# Rows one window partition or one numpy block should hold.
BUCKET_ROWS = 1 << 20
# Hex digits of a global order's buckets, at least: small inputs get the same plan.
MIN_DIGITS = 2
# Blocks whose boundary maps are chained in one task.
CHAIN_BLOCKS = 64
# Groups in which the samples of all partitions meet first, and rows that Spark's group limit takes.
MERGE_GROUPS = 256
GROUP_LIMIT = 1000


def padded_rows(rows: Column, group_rows: int = ROW_GROUP_ROWS) -> Column:
    return (F.ceil(rows / F.lit(group_rows)) * group_rows).cast("bigint")


def _bucket_starts(df: DataFrame, value: Column, *group: str) -> DataFrame:
    """Total of ``value`` in the earlier buckets, per bucket.

    Only the bucket totals are ordered in one place: 16**digits rows, which is
    65,536 for 40 billion documents.
    """
    order = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = order.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, "bucket").agg(value.alias("_part"))
    start = F.coalesce(F.sum("_part").over(earlier), F.lit(0)).cast("bigint")
    return sums.select(*group, "bucket", start.alias("start"))


def seeded_positions(
    df: DataFrame, row_id: str, seed: int = SHUFFLE_SEED, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``(row_id, shuffle_key, pos)``: 0-based position of every row in the seeded shuffle.

    Rows are ordered inside evenly filled key buckets and shifted by the sizes
    of the earlier buckets; nothing sorts the whole table in one task.
    """
    ids = df.select(row_id)
    digits = max(MIN_DIGITS, bucket_digits(ids.count(), bucket_rows))
    key = shuffle_key(F.col(row_id), seed)
    keyed = ids.withColumn("shuffle_key", key).withColumn("bucket", key_bucket(key, digits))
    starts = broadcast_within(_bucket_starts(keyed, F.count(F.lit(1))), 16**digits)
    in_bucket = Window.partitionBy("bucket").orderBy("shuffle_key", row_id)
    return (
        keyed.withColumn("_rank", F.row_number().over(in_bucket) - 1)
        .join(starts, "bucket")
        .select(row_id, "shuffle_key", (F.col("start") + F.col("_rank")).cast("bigint").alias("pos"))
    )


@dataclass(frozen=True)
class ShardPlan:
    """Where every shard of a packed corpus ends, as keys of the seeded shuffle."""

    placed: DataFrame
    lookup: DataFrame
    lookup_rows: int
    digits: int
    seed: int
    first_shard: int = 0

    def _place(self, keyed: DataFrame) -> DataFrame:
        here = F.size(F.filter("closing", lambda k: k < F.col("shuffle_key")))
        return (
            keyed.withColumn("bucket", key_bucket(F.col("shuffle_key"), self.digits))
            .join(broadcast_within(self.lookup, self.lookup_rows), "bucket")
            .withColumn("shard", (F.col("closed") + here + self.first_shard).cast("bigint"))
            .drop("bucket", "closing", "closed")
        )

    def assign(self, df: DataFrame, row_id: str = "doc_id") -> DataFrame:
        """Add ``shuffle_key`` and ``shard``; row-local, the texts are not shuffled."""
        return self._place(df.withColumn("shuffle_key", shuffle_key(F.col(row_id), self.seed)))

    def sizes(self) -> DataFrame:
        """Rows per shard, from the stored keys; these lie in shuffle order, so that
        the map side already combines most of them."""
        keys = self.placed.select(F.col("key").alias("shuffle_key"))
        return self._place(keys).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


def plan_shards(
    df: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    chars: str | None = None,
    target: int = SHARD_CHARS,
    seed: int = SHUFFLE_SEED,
    bucket_rows: int = BUCKET_ROWS,
    chain_blocks: int = CHAIN_BLOCKS,
    first_shard: int = 0,
    carry: int = 0,
) -> ShardPlan:
    """Greedy packing of the seeded shuffle.

    Numbers go on from ``first_shard``, in which ``carry`` characters, fewer than
    ``target``, lie already.

    A shard closes with the document that brings it to ``target`` characters
    and the next one starts empty. Only keys and lengths are handled here;
    ``chars`` names a stored length column, so that no text is read at all.
    Null or repeated row ids are refused: their order would not be defined.
    """
    if not 0 <= carry < target:
        raise ValueError("the open shard holds fewer characters than its target")
    key = shuffle_key(F.col(row_id), seed)
    length = F.col(chars) if chars else F.length(text)
    lengths = materialize(
        df.select(key.alias("key"), F.coalesce(length, F.lit(0)).cast("bigint").alias("chars")),
        "lengths",
    )
    rows, nulls, total = lengths.agg(
        F.count("key"), F.count_if(F.col("key").isNull()), F.coalesce(F.sum("chars"), F.lit(0))
    ).first()
    if nulls:
        raise ValueError(f"{nulls} rows have no {row_id}")
    digits = max(MIN_DIGITS, bucket_digits(rows, bucket_rows), bucket_digits(total // target, 16))
    buckets = 16**digits

    keyed = lengths.withColumn("bucket", key_bucket(F.col("key"), digits))
    starts = broadcast_within(_bucket_starts(keyed, F.sum("chars")), buckets)
    in_bucket = Window.partitionBy("bucket").orderBy("key")
    running = F.sum("chars").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0))
    placed = materialize(
        keyed.withColumn("_running", running)
        .withColumn("repeated", F.coalesce(F.lag("key").over(in_bucket) == F.col("key"), F.lit(False)))
        .join(starts, "bucket")
        .select("bucket", "key", "chars", "repeated", (F.col("start") + F.col("_running")).alias("cum")),
        "placed",
    )
    if not placed.where("repeated").isEmpty():
        raise ValueError(f"values of {row_id} repeat")
    # An empty document shares its "cum" with the one before and never closes a shard;
    # without them the totals are strictly increasing.
    filled = placed.where("chars > 0")
    ends = shard_ends(filled.select("cum"), rows, total, target, bucket_rows, chain_blocks, target - carry)
    closing = (
        filled.join(broadcast_within(ends, (total + carry) // target + 1), "cum")
        .groupBy("bucket")
        .agg(F.array_sort(F.collect_list("key")).alias("closing"))
    )
    earlier = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast("array<string>")
    lookup = (
        df.sparkSession.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(closing, "bucket", "left")
        .withColumn("closing", F.coalesce("closing", none))
        .withColumn("closed", F.coalesce(F.sum(F.size("closing")).over(earlier), F.lit(0)))
    )
    return ShardPlan(
        placed=placed,
        lookup=materialize(lookup, "closing"),
        lookup_rows=buckets + (total + carry) // target,
        digits=digits,
        seed=seed,
        first_shard=first_shard,
    )


def pack_shards(df: DataFrame, row_id: str = "doc_id", **options) -> DataFrame:
    """Add ``shuffle_key`` and ``shard``; the options are those of plan_shards."""
    return plan_shards(df, row_id, **options).assign(df, row_id)


def shard_ends(
    cums: DataFrame,
    rows: int,
    total: int,
    target: int,
    block_rows: int = BUCKET_ROWS,
    chain_blocks: int = CHAIN_BLOCKS,
    first: int | None = None,
) -> DataFrame:
    """Running totals (distinct ``cum`` values) at which a shard closes.

    The first end is the first total at or above ``first`` (``target`` unless
    given, and never more). The next end is the first total at or above "last end + target", a chain
    with one link per shard. It is cut into blocks of the value range. Every
    block is mapped in parallel from each end it may be entered at to the
    threshold it leaves behind; the maps of ``chain_blocks`` neighbours are
    composed, level by level, until one group is left; its known entry is then
    handed down again and each block lists its own ends.
    """
    spark = cums.sparkSession
    rows_per_shard = max(1, rows * target // max(total, 1))
    span = max(1, block_rows // rows_per_shard) * target
    n_blocks = total // span + 1
    blocked = cums.select(whole_div(F.col("cum"), span).alias("block"), "cum")
    entered = spark.createDataFrame([(0, target if first is None else first)], "block bigint, threshold bigint")

    def walk_thresholds(blocks: list, thresholds: np.ndarray) -> np.ndarray:
        for entries, exits in blocks:
            at = np.searchsorted(entries, thresholds)
            hit = at < len(entries)
            thresholds = np.where(hit, exits[np.minimum(at, len(entries) - 1)], thresholds)
        return thresholds

    def in_order(pdf: pd.DataFrame) -> list:
        ordered = pdf.sort_values(["block", "entry"])
        return [
            (number, part["entry"].to_numpy(), part["exit"].to_numpy())
            for number, part in ordered.groupby("block", sort=True)
        ]

    def reachable(values: np.ndarray, start: int) -> np.ndarray:
        """Ends a block can be entered at: thresholds reach at most start + target."""
        return values[: np.searchsorted(values, start + target) + 1]

    def map_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["cum"].to_numpy())
        entries = reachable(values, key[0] * span)
        thresholds = entries + target
        while True:
            at = np.searchsorted(values, thresholds)
            inside = at < len(values)
            if not inside.any():
                break
            thresholds = np.where(inside, values[np.minimum(at, len(values) - 1)] + target, thresholds)
        return pd.DataFrame({"block": key[0], "entry": entries, "exit": thresholds})

    def compose_at(width: int):
        def compose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            parts = [(entries, exits) for _, entries, exits in in_order(pdf)]
            entries = reachable(np.concatenate([e for e, _ in parts]), key[0] * width)
            return pd.DataFrame(
                {"block": key[0], "entry": entries, "exit": walk_thresholds(parts, entries)}
            )

        return compose

    map_schema = "block bigint, entry bigint, exit bigint"
    levels: list[DataFrame] = []
    if n_blocks > 1:
        levels.append(materialize(blocked.groupBy("block").applyInPandas(map_block, map_schema), "maps"))
    width, groups = span, n_blocks
    while groups > chain_blocks:
        width *= chain_blocks
        groups = -(-groups // chain_blocks)
        grouped = levels[-1].withColumn("group", whole_div(F.col("block"), chain_blocks))
        composed = grouped.groupBy("group").applyInPandas(compose_at(width), map_schema)
        levels.append(materialize(composed, "maps"))

    def hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
        threshold = np.array([pdf["threshold"].iloc[0]])
        out = []
        for number, entries, exits in in_order(pdf):
            out.append((number, int(threshold[0])))
            threshold = walk_thresholds([(entries, exits)], threshold)
        return pd.DataFrame(out, columns=["block", "threshold"])

    for level in reversed(levels):
        known = entered.withColumnRenamed("block", "group")
        entered = materialize(
            level.withColumn("group", whole_div(F.col("block"), chain_blocks))
            .join(known, "group")
            .groupBy("group")
            .applyInPandas(hand_down, "block bigint, threshold bigint"),
            "entered",
        )

    def list_ends(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["cum"].to_numpy())
        threshold = pdf["threshold"].iloc[0]
        ends = []
        while (at := np.searchsorted(values, threshold)) < len(values):
            ends.append(values[at])
            threshold = values[at] + target
        return pd.DataFrame({"cum": np.array(ends, dtype="int64")})

    return (
        blocked.join(broadcast_within(entered, n_blocks), "block")
        .groupBy("block")
        .applyInPandas(list_ends, "cum bigint")
    )


def pad_shards(
    df: DataFrame,
    shard: str = "shard",
    row_id: str = "doc_id",
    order: str = "shuffle_key",
    group_rows: int = ROW_GROUP_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    sizes: DataFrame | None = None,
    whole_shards: bool = False,
) -> DataFrame:
    """Fill every shard to a multiple of ``group_rows`` with copies of its own rows.

    Copy j of shard s repeats the row at rank ``md5(s:j) mod n``, i.e. a draw
    with replacement. Added: ``is_pad``, and ``copy`` (0 for the row itself).
    ``order`` is a hex key; ``sizes`` (shard, n) saves the counting pass.

    Rows are ranked in key buckets, so a single huge shard does not end up in
    one task. ``whole_shards`` is for packed shards, which are bounded and
    become one file each: the rows are shuffled once, by shard, the draws (one
    row per shard) are moved to them, and ``write_shards(clustered=True)`` needs
    no further shuffle. Either way the plan is the same at every size.
    """
    if sizes is None:
        sizes = df.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes, "sizes")
    n_shards, largest = sizes.agg(F.count("n"), F.coalesce(F.max("n"), F.lit(0))).first()
    missing = (group_rows - F.col("n") % group_rows).cast("int")
    draw = F.conv(
        F.substring(F.md5(F.concat(F.col(shard).cast("string"), F.lit(":"), F.col("copy"))), 1, 8), 16, 10
    ).cast("bigint")
    draws = (
        sizes.where(F.col("n") % group_rows != 0)
        .select(shard, "n", F.explode(F.sequence(F.lit(1), missing)).alias("copy"))
        .select(shard, (draw % F.col("n")).alias("rank"), "copy")
        .groupBy(shard, "rank")
        .agg(F.collect_list("copy").alias("copies"))
    )

    if whole_shards:
        # Both sides are dealt by shard to as many tasks, so only the draws move for the join.
        tasks = max(1, n_shards)
        of_shard = F.map_from_entries(F.collect_list(F.struct("rank", "copies"))).alias("copies")
        placed = draws.groupBy(shard).agg(of_shard).repartition(tasks, shard).hint("shuffle_hash")
        in_shard = Window.partitionBy(shard).orderBy(order, row_id)
        ranked = df.repartition(tasks, shard).withColumn("rank", (F.row_number().over(in_shard) - 1).cast("bigint"))
        joined = ranked.join(placed, shard, "left").withColumn("copies", F.try_element_at("copies", "rank"))
    else:
        digits = max(1, bucket_digits(largest, bucket_rows))
        keyed = df.withColumn("bucket", key_bucket(F.col(order), digits))
        in_bucket = Window.partitionBy(shard, "bucket").orderBy(order, row_id)
        starts = broadcast_within(_bucket_starts(keyed, F.count(F.lit(1)), shard), n_shards * 16**digits)
        ranked = (
            keyed.withColumn("_rank", (F.row_number().over(in_bucket) - 1).cast("bigint"))
            .join(starts, [shard, "bucket"])
            .withColumn("rank", F.col("start") + F.col("_rank"))
            .drop("_rank", "start", "bucket")
        )
        joined = ranked.join(broadcast_within(draws, n_shards * group_rows), [shard, "rank"], "left")
    itself = F.array(F.lit(0))
    copies = F.coalesce(F.concat(itself, F.col("copies")), itself)
    return (
        joined.withColumn("copy", F.explode(copies))
        .withColumn("is_pad", F.col("copy") > 0)
        .drop("rank", "copies")
    )


def bottom_k(df: DataFrame, k: int, *order: str) -> DataFrame:
    """The first ``k`` rows by ``order``, in one job over any number of partitions.

    Each partition keeps its first k; these meet in ``MERGE_GROUPS`` groups that
    keep theirs, and only then in one place. Wide rows or a larger k than
    ``GROUP_LIMIT`` (up to which Spark cuts before a shuffle): see sample_rows.
    """
    grouped = df.withColumn("_group", F.spark_partition_id() % MERGE_GROUPS)
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    return grouped.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_group", "_rank").orderBy(*order).limit(k)


def sample_rows(df: DataFrame, k: int, row_id: str, seed: int = SAMPLE_SEED) -> DataFrame:
    """Seeded sample of ``min(k, n)`` rows with an id, without replacement: the k smallest keys.

    One pass, without a count: see bottom_k. For a large k only the keys are
    merged, and a second pass takes the rows up to the last one.
    """
    keyed = df.where(F.col(row_id).isNotNull()).withColumn("_key", shuffle_key(F.col(row_id), seed))
    if k > GROUP_LIMIT:
        last = bottom_k(keyed.select("_key"), k, "_key").agg(F.max("_key")).first()[0]
        return keyed.where(F.col("_key") <= F.lit(last)).orderBy("_key", row_id).limit(k).drop("_key")
    return bottom_k(keyed, k, "_key", row_id).drop("_key")


def sample_previews(
    df: DataFrame, k: int = 5, row_id: str = "doc_id", text: str = "text", seed: int = SAMPLE_SEED
) -> DataFrame:
    shown = df.select(row_id, F.length(text).alias("chars"), preview(F.col(text)).alias("preview"))
    return sample_rows(shown, k, row_id, seed)


def train_val_split(df: DataFrame, shard: str = "shard") -> DataFrame:
    """Label the last shard ``val``, all others ``train``."""
    last = df.agg(F.max(shard).alias(shard)).withColumn("_last", F.lit(True))
    split = F.when(F.col("_last"), "val").otherwise("train")
    return df.join(F.broadcast(last), shard, "left").withColumn("split", split).drop("_last")


def window_of(df: DataFrame, row_id: str, skip: int, target: int, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Resume a seeded order: skip what exists, take up to ``target`` in total."""
    positions = seeded_positions(df, row_id, seed)
    wanted = positions.where((F.col("pos") >= skip) & (F.col("pos") < target))
    return df.join(wanted.select(row_id, "pos"), row_id)
