"""Substring dedup against windows compared one by one."""

import hashlib
import random

import pytest

from quillsieve.llm import queries, substring


def brute_rows(rows, window):
    """(doc_id, n_words, n_removed, kept_text) of each row by itself; a missing id is larger than all others."""
    words = [(float("inf") if d is None else d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, d), d)
    out = []
    for (name, _), (d, w) in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((name, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def brute(rows, window):
    return {r[0]: r[1:] for r in brute_rows(rows, window)}


def made_rows(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "x y"]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(20, 200))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(0, 4)):
            source = r.choice(base).split()
            low = r.randint(0, len(source) - 1)
            parts += source[low : low + r.randint(5, 120)] if r.random() < 0.7 else [r.choice(vocabulary)] * r.randint(0, 70)
        rows.append((i * 7919 % 1000 - 300, r.choice([" ", "\n", " \t"]).join(parts)))
    return rows + [(5000, None), (5001, ""), (5002, base[0]), (5003, base[0])]


@pytest.mark.parametrize("seed,window,block,step", [(1, 50, 11, 3), (2, 50, 25, 1), (3, 12, 3, 2)])
def test_equals_brute_force(spark, seed, window, block, step):
    rows = made_rows(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = substring.remove_repeats(df, window=window, block=block, step=step).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == brute(rows, window)


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.texts(spark, sf_dir).collect()]
    want = {d: (n, g, hashlib.sha256(t.encode()).hexdigest()) for d, (n, g, t) in brute(rows, 50).items()}
    got = queries.op5_substring_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
    assert any(g for _, g, _ in want.values())


def test_edges(spark):
    kind = "doc_id bigint, text string, kept_text int, tag string"
    assert substring.remove_repeats(spark.createDataFrame([], kind)).collect() == []
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(None, long, 1, "a"), (3, long, 2, "b"), (3, long, 3, "c"), (2, "short", 4, None)]
    got = substring.remove_repeats(spark.createDataFrame(rows, kind)).collect()
    assert {(r.doc_id, r.tag, r.n_words, r.n_removed) for r in got} == {
        (None, "a", 60, 60), (3, "b", 60, 0), (3, "c", 60, 0), (2, None, 1, 0)
    }


def by_row(df, **options):
    return sorted((tuple(r) for r in substring.remove_repeats(df, **options).select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=repr)


def test_rows_with_one_id_or_none(spark):
    """Every row is judged by its own text; unrelated rows that share an id, or lack one, keep their words."""
    r = random.Random(6)
    rows = [(r.choice([None, None, 7, 7, 3, n]), t) for n, (_, t) in enumerate(made_rows(4))]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1, passage), (None, f"{passage} own words"), (None, " ".join(f"q{i}" for i in range(90))), (None, " ".join(f"z{i}" for i in range(70)))]
    rows += [(7, f"new {passage}"), (7, " ".join(f"s{i}" for i in range(80))), (None, f"{passage} own words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = sorted(brute_rows(rows, 50), key=repr)
    assert by_row(df) == want
    assert by_row(df, bucket_bytes=500, group_bytes=500) == want


def test_rows_without_id_spread(spark):
    """A third of the rows without id does not end up in one group."""
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "concat('text ', id) as text")
    sizes = rows.select((substring._row_mark() % 16).alias("g")).groupBy("g").count()
    assert sizes.agg({"count": "max"}).first()[0] < 300


def test_clashing_columns_and_a_long_text(spark):
    words = [f"w{i}" for i in range(400_000)]
    rows = [(1, " ".join(words[1000:1100]), 1, 2, 3), (2, " ".join(words), 4, 5, 6), (3, "", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, group int, mark int, n_words int")
    got = {r.doc_id: r for r in substring.remove_repeats(df).collect()}
    assert [(got[d].group, got[d].mark, got[d].n_words, got[d].n_removed) for d in (1, 2, 3)] == [(1, 2, 100, 0), (4, 5, 400_000, 100), (7, 8, 0, 0)]
    named = substring.remove_repeats(df, names=("a", "b", "c")).collect()
    assert {(r.doc_id, r.n_words, r.a, r.b) for r in named} == {(1, 3, 100, 0), (2, 6, 400_000, 100), (3, 9, 0, 0)}


def test_parameters(spark):
    with pytest.raises(ValueError):
        substring.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string"), block=12, step=3)
