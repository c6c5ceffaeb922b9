"""Top-k search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from quillsieve.llm import queries, topk


def brute(rows, k):
    known = {i: v for i, v in rows}
    out = set()
    for q in (i for i in known if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(known[q], v)), i) for i, v in known.items() if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "few"])
def test_equals_brute_force(spark, kind):
    r = np.random.default_rng(len(kind))
    n = 6 if kind == "few" else 700
    points = r.normal(size=(n, 6)) * 300
    if kind == "clusters":
        points = r.normal(size=(12, 6))[r.integers(0, 12, n)] * 900 + r.normal(size=(n, 6)) * 9
    if kind == "copies":
        points[r.random(n) < 0.5] = points[0]
    rows = [(int(i) * 3 - 60, [int(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 10, pivots=5, sample=100, ring_rows=20, part_rows=50)
    assert {tuple(x) for x in got.collect()} == brute(rows, 10)


def test_annuli_are_skipped(spark):
    """On clustered vectors the bounds leave most annuli out."""
    r = np.random.default_rng(1)
    points = np.repeat(r.normal(size=(20, 8)) * 900, 40, axis=0) + r.normal(size=(800, 8)) * 4
    df = spark.createDataFrame([(i, [int(x) for x in p]) for i, p in enumerate(points)], "vec_id bigint, v array<bigint>")
    index = topk.build_index(df, pivots=20, ring_rows=10)
    found = topk.top_k(df, F.col("vec_id") % 100 == 0, 10, pivots=20, ring_rows=10)
    last = found.where("rank = 10").select("query_id", F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
    state = df.select(F.col("vec_id").alias("query_id"), "v").join(last, "query_id")
    visited = topk._annuli(state, index, 2).count()
    assert visited < 0.5 * state.count() * index.parts.count()


def test_edges(spark):
    kind = "vec_id bigint, embedding array<float>, score string"
    assert topk.top_k(topk.quantised(spark.createDataFrame([], kind)), F.col("vec_id") % 100 == 0).collect() == []
    rows = [
        (0, [1.0, -0.0001], "x"), (0, [1.0, -0.0001], "x"), (1, [1.0, None], "x"), (2, None, "x"), (3, [float("nan"), 1.0], "x"),
        (4, [float("inf"), 1.0], "x"), (5, [0.5], None), (6, [], "x"), (None, [1.0, 1.0], "x"), (7, [0.5, 0.0], "x"),
    ]
    got = topk.top_k(topk.quantised(spark.createDataFrame(rows, kind)), F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, 1, 5, 512 * 1024), (0, 2, 7, 512 * 1024), (0, 3, 6, 0)]


def test_table(spark, sf_dir):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = connection.sql(contract.oracle_sql()["op2_top_k"]).fetchall()
    assert sorted(tuple(r) for r in queries.op2_top_k(spark, sf_dir).collect()) == sorted(want)
