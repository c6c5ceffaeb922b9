import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillsieve.functions.ordering import bucket_digits
from quillsieve.operators import packing


def key(value, seed=42):
    return hashlib.md5(f"{seed}:{value}".encode()).hexdigest()


def brute_pack(rows, target):
    shard, filled, out = 0, 0, {}
    for doc_id, text in sorted(rows, key=lambda r: key(r[0])):
        out[doc_id] = shard
        filled += len(text or "")
        if filled >= target:
            shard, filled = shard + 1, 0
    return out


def packed(spark, rows, target, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: r.shard for r in packing.pack_shards(df, target=target, **options).collect()}


CASES = {
    "mixed": [random.Random(1).randint(0, 60) for _ in range(400)],
    "one_giant": [5] * 100 + [5000] + [5] * 100,
    "all_above_target": [150] * 40,
    "empty_texts": [0, 0, 10, 0, 100, 0] * 20,
    "unit": [1] * 300,
}


@pytest.mark.parametrize("name", CASES)
def test_pack_equals_sequential_loop(spark, name):
    rows = [(i, "x" * n if n else ("" if i % 2 else None)) for i, n in enumerate(CASES[name])]
    for target in (100, 10**9):
        assert packed(spark, rows, target) == brute_pack(rows, target)


@pytest.mark.parametrize("name", ["mixed", "one_giant", "empty_texts"])
def test_pack_through_many_blocks_and_levels(spark, name):
    """Tiny blocks force maps to be composed and handed down over several levels."""
    rows = [(i, "x" * n) for i, n in enumerate(CASES[name])]
    got = packed(spark, rows, 100, bucket_rows=4, chain_blocks=2)
    assert got == brute_pack(rows, 100)


def test_pack_exact_hit_at_the_end_opens_no_empty_shard(spark):
    rows = [(i, "x" * 50) for i in range(8)]
    assert set(packed(spark, rows, 100).values()) == {0, 1, 2, 3}


def test_pack_empty_and_single(spark):
    assert packed(spark, [], 100) == {}
    assert packed(spark, [(1, "abc")], 100) == {1: 0}


def test_pack_does_not_shuffle_texts(spark, docs):
    plan = packing.pack_shards(docs.select("doc_id", "text"), target=50_000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("bucket_rows", [1 << 20, 20])
def test_seeded_positions(spark, bucket_rows):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.pos for r in packing.seeded_positions(df, "doc_id", bucket_rows=bucket_rows).collect()}
    expected = {d: p for p, d in enumerate(sorted(range(500), key=key))}
    assert got == expected


def brute_pads(ids, shard, group):
    ordered = sorted(ids, key=key)
    missing = -len(ordered) % group
    picks = (int(hashlib.md5(f"{shard}:{j}".encode()).hexdigest()[:8], 16) % len(ordered) for j in range(1, missing + 1))
    return Counter(ordered[p] for p in picks)


@pytest.mark.parametrize("bucket_rows", [1 << 20, 16])
def test_padding(spark, bucket_rows):
    """One shard holds most rows; multiples and single rows are included."""
    sizes = {0: 500, 1: 64, 2: 1, 3: 63, 4: 65}
    rows, next_id = [], 0
    for shard, n in sizes.items():
        rows += [(next_id + i, shard) for i in range(n)]
        next_id += n
    df = spark.createDataFrame(rows, "doc_id bigint, shard bigint").withColumn(
        "shuffle_key", F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")))
    )
    out = packing.pad_shards(df, group_rows=64, bucket_rows=bucket_rows).collect()
    for shard, n in sizes.items():
        mine = [r for r in out if r.shard == shard]
        ids = [d for d, s in rows if s == shard]
        assert len(mine) % 64 == 0
        assert sorted(r.doc_id for r in mine if not r.is_pad) == ids
        pads = Counter(r.doc_id for r in mine if r.is_pad)
        assert pads == brute_pads(ids, shard, 64)


def test_whole_shards_stay_whole(spark, tmp_path):
    """More than 1,000 shards: one plan, one exchange of the texts, one file per shard, full row groups."""
    import pyarrow.parquet as pq

    from quillsieve.sources.shards import write_shards

    n_shards, group = 1010, 8
    df = spark.range(n_shards * 5).select(
        F.col("id").alias("doc_id"), (F.col("id") % n_shards).alias("shard"), F.concat(F.lit("text "), "id").alias("text")
    ).where("shard % 3 <> 0 OR doc_id < 2000")
    df = df.withColumn("shuffle_key", F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = packing.pad_shards(df, group_rows=group, whole_shards=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
        texts = [x for x in plan.split("\n") if "Exchange" in x and "text#" in x]
        assert plan.count("REPARTITION_BY_NUM") == 2 and len(texts) <= 1
        write_shards(out, f"{tmp_path}/out", group_rows=group, clustered=True, extra=("doc_id",))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    files = sorted(tmp_path.glob("out/shard=*/*.parquet"))
    assert len(files) == n_shards
    for file in files[::50]:
        meta = pq.ParquetFile(file).metadata
        assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [group] * (meta.num_rows // group)
    rows = {}
    for r in df.select("shard", "doc_id").collect():
        rows.setdefault(r.shard, []).append(r.doc_id)
    for file in files[::50]:
        shard = int(file.parent.name.removeprefix("shard="))
        copies = Counter(pq.read_table(file, partitioning=None)["doc_id"].to_pylist())
        assert copies - Counter(rows[shard]) == brute_pads(rows[shard], shard, group)


def test_padding_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, shard bigint, shuffle_key string")
    assert packing.pad_shards(df).count() == 0


def test_sample_is_without_replacement_and_bounded(spark):
    df = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("a\nb").alias("text"))
    assert packing.sample_rows(df, 20, "doc_id").count() == 10
    got = [r.doc_id for r in packing.sample_previews(df, 3).collect()]
    assert got == sorted(range(10), key=lambda i: key(i, 123))[:3]


def test_sample_of_a_large_input_is_the_same(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    got = [r.doc_id for r in packing.sample_rows(df, 50, "doc_id").collect()]
    assert got == sorted(range(5000), key=lambda i: key(i, 123))[:50]


def test_split_takes_last_shard(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 2)], "doc_id int, shard bigint")
    got = {r.doc_id: r.split for r in packing.train_val_split(df).collect()}
    assert got == {1: "train", 2: "train", 3: "val", 4: "val"}
    one = {r.split for r in packing.train_val_split(df.where("shard = 0")).collect()}
    assert one == {"val"}


def test_resume_window(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("task_id"))
    got = {r.task_id for r in packing.window_of(df, "task_id", 10, 25).collect()}
    assert got == set(sorted(map(str, range(50)), key=key)[10:25])
    assert packing.window_of(df, "task_id", 30, 25).count() == 0
    assert packing.window_of(df, "task_id", 45, 500).count() == 5


def test_bucket_digits():
    assert [bucket_digits(n, 100) for n in (0, 100, 101, 1600, 1601)] == [0, 0, 1, 1, 2]
