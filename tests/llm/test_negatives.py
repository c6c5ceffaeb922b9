"""Hard negatives against all pairs."""

import random

import numpy as np
import pytest

from quillsieve.llm import negatives, queries

KIND = "vec_id bigint, label int, embedding array<float>"


def brute(rows, is_anchor, scale=256):
    kept = []
    for vec_id, label, e in rows:
        if vec_id is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        kept.append((vec_id, label, [int(np.floor(scale * float(np.float32(x)))) for x in e]))
    anchors = {}
    for row in kept:
        if is_anchor(row[0]):
            anchors[row[0]] = min(anchors.get(row[0], row), row, key=lambda r: r[1:])
    out = []
    for a, label, v in anchors.values():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, other, w in kept if i != a)
        for place, (minus, positive, _) in enumerate([s for s in scored if s[2]][:5]):
            fit = [s for s in scored if not s[2] and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:5]
            out += [(a, positive, n + 1, i, -minus, -s) for n, (s, i, _) in enumerate(fit)]
    return sorted(out)


def mined(df, anchor, **bounds):
    return sorted(tuple(r) for r in negatives.mine(negatives.quantised(df), anchor, **bounds).collect())


def vectors(count, width, seed, spread=1.0):
    r = random.Random(seed)
    rows = []
    for n in range(count):
        label = r.randrange(4)
        length = r.choice([1.0, 1.0, 0.5, 0.05, 3.0])
        middle = [spread * (i == label) for i in range(width)]
        rows.append((n, label, [length * (m + r.gauss(0, 0.35)) for m in middle]))
    return rows


@pytest.mark.parametrize("bounds", [{}, {"part_rows": 16, "block_rows": 4, "focus": 2}, {"part_rows": 40, "focus": 9}])
def test_all_pairs(spark, bounds):
    rows = vectors(400, 8, 3)
    df = spark.createDataFrame(rows, KIND).repartition(3)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert mined(df, df.vec_id % 10 == 0, **bounds) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 5) + [
        (None, 1, [1.0] * 4), (1000, None, [1.0] * 4), (1010, 1, None), (1020, 1, [1.0, None, 1.0, 1.0]),
        (1030, 1, [nan, 1.0, 1.0, 1.0]), (1040, 1, [inf, 1.0, 1.0, 1.0]), (1050, 2, [0.0] * 4), (1060, 2, []),
        (1070, 3, [1.0, 1.0]), (1080, 3, [-1.0, -1.0, -1.0, -1.0]),
    ]
    # Ties: one vector under many ids and labels; and repeated rows.
    rows += [(2000 + n, n % 3, [0.5, 0.5, 0.5, 0.5]) for n in range(30)] + [(2001, 1, [0.5, 0.5, 0.5, 0.5])] * 3
    rows += [(2010, 0, [0.25] * 4), (2010, 1, [0.5] * 4)]
    extra = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND + ", part int, score string").repartition(4)
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(extra, extra.vec_id % 10 == 0, part_rows=16, block_rows=2) == want


def test_empty(spark):
    empty = spark.createDataFrame([], KIND)
    assert mined(empty, empty.vec_id % 10 == 0) == []
    none = spark.createDataFrame([(1, 1, [1.0]), (2, 2, [1.0])], KIND)
    assert mined(none, none.vec_id % 10 == 0) == []
    alone = spark.createDataFrame([(10, 1, [1.0]), (20, 1, [1.0])], KIND)
    assert mined(alone, alone.vec_id % 10 == 0) == []


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding").collect()]
    moved = [(i, None if c is None else (c + 1) % 10 if i % 7 == 0 else c, e) for i, c, e in rows]
    assert sorted(tuple(r) for r in queries.op12_hard_negatives(spark, sf_dir).collect()) == brute(moved, lambda i: i % 100 == 0)


def test_ranges_lose_nothing():
    """Every row that reaches a score lies within the ranges, and they do exclude others."""
    import pyarrow as pa

    r = np.random.default_rng(2)
    v = r.integers(-200, 200, (500, 6))
    part = negatives.Part(pa.table({"vec_id": np.arange(500), "v": [list(map(int, x)) for x in v]}), 6)
    excluded = 0
    for anchor in v[:40]:
        scores = part.vectors @ anchor
        for least in np.quantile(scores, [0.5, 0.9, 0.99, 1.0]):
            found = part.feasible(anchor, float(least), 4)
            assert set(np.flatnonzero(scores >= least)) <= set(found)
            excluded += 500 - len(found)
    assert excluded > 10_000
