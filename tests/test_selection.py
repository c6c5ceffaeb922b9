import random

import pytest
from pyspark.sql import functions as F

from quillsieve.operators import selection


def brute_cut(rows, budget):
    """Sequential rule: take a row while the total before it is below budget."""
    total, kept = 0, []
    for ord_, row_id, tokens in sorted(rows, key=lambda r: (r[0], r[1])):
        if total >= budget:
            break
        kept.append((ord_, row_id))
        total += tokens or 0
    return set(kept)


def frame(spark, rows):
    return spark.createDataFrame(rows, "ord int, row_id bigint, tokens bigint")


def kept(df):
    return {(r["ord"], r.row_id) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_budget_cut_equals_sequential_rule(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(10**12), 150) + list(range(150))
    rows = [(rng.randint(0, 2), i, rng.choice([None, 0, 1, 5, 100])) for i in ids]
    total = sum(t or 0 for *_, t in rows)
    df = frame(spark, rows)
    for budget in (0, 1, total // 3, total - 1, total, total + 1):
        cut = selection.budget_cut(df, budget, leaf_rows=10, splits=4)
        assert kept(cut) == brute_cut(rows, budget), budget


def test_budget_cut_with_hash_like_ids(spark):
    rng = random.Random(8)
    rows = [(0, rng.randint(-(2**63), 2**63 - 1), 1) for _ in range(200)]
    rows += [(0, 2**63 - 1 - i, 1) for i in range(100)]
    for budget in (50, 150, 250, 290):
        cut = selection.budget_cut(frame(spark, rows), budget, leaf_rows=5, splits=8)
        assert kept(cut) == brute_cut(rows, budget)


def test_budget_cut_exact_hit_and_overshoot(spark):
    df = frame(spark, [(0, 1, 10), (0, 2, 10), (0, 3, 0), (0, 4, 10)])
    assert kept(selection.budget_cut(df, 20)) == {(0, 1), (0, 2)}
    assert kept(selection.budget_cut(df, 21)) == {(0, 1), (0, 2), (0, 3), (0, 4)}


def test_budget_continues_across_subsets(spark):
    df = frame(spark, [(1, 1, 10), (0, 5, 10), (2, 0, 10)])
    assert kept(selection.budget_cut(df, 11)) == {(0, 5), (1, 1)}


def test_grouped_budgets_are_independent(spark):
    rows = [("a", 0, i, 10) for i in range(5)] + [("b", 0, i, 10) for i in range(5)] + [("c", 0, 0, 10)]
    df = spark.createDataFrame(rows, "kind string, ord int, row_id bigint, tokens bigint")
    cut = selection.budget_cut(df, {"a": 25, "b": 1000, "d": 5}, group="kind", leaf_rows=2, splits=2)
    got = sorted((r.kind, r.row_id) for r in cut.collect())
    assert got == [("a", 0), ("a", 1), ("a", 2)] + [("b", i) for i in range(5)]


def test_budget_result_is_a_filter(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lit(0).alias("ord"), F.col("doc_id").alias("row_id"), "text", F.col("n_chars").alias("tokens")
    )
    plan = selection.budget_cut(df, 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "LessThanOrEqual(doc_id" in plan


def test_empty_input(spark):
    assert selection.budget_cut(frame(spark, []), 10).count() == 0


def test_fraction_budgets_truncate():
    assert selection.fraction_budgets(1001) == {"educational": int(1001 * 0.7), "books": int(1001 * 0.3)}


def test_catalog_select(spark):
    rows = [(3, ["en"], ["Children's stories"]), (1, ["fr", "en"], ["x", "CHILDREN"]), (2, ["fr"], ["children"]), (3, ["en"], ["children"]), (4, ["en"], [])]
    df = spark.createDataFrame(rows, "id bigint, languages array<string>, topics array<string>")
    assert [r.id for r in selection.catalog_select(df).collect()] == [1, 3]


def test_epoch_mixture(spark):
    one = spark.createDataFrame([("x",), ("y",)], "text string")
    mixed = selection.epoch_mixture({"a": (one, 3), "b": (one, 1), "c": (one, 0)})
    counts = {(r.dataset, r.epoch): r["count"] for r in mixed.groupBy("dataset", "epoch").count().collect()}
    assert counts == {("a", 1): 2, ("a", 2): 2, ("a", 3): 2, ("b", 1): 2}


def test_union_keeps_duplicates(spark):
    one = spark.createDataFrame([("x",)], "text string")
    assert selection.union_sources([one, one, one]).count() == 3


def test_capped_extract(spark):
    df = spark.createDataFrame([(0, i, "ab" * 10) for i in range(5)], "ord int, row_id bigint, text string")
    got = selection.capped_extract(df, doc_cap=6, max_chars=13).collect()
    assert sorted((r.row_id, r.text) for r in got) == [(0, "ababab"), (1, "ababab"), (2, "ababab")]
