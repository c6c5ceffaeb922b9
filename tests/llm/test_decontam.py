"""Decontamination against every diagonal."""

import itertools
import random

import numpy as np
import pytest

from quillsieve.llm import decontam, queries


def fold(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()


def brute(docs, items, least=13, share=0.8):
    out = {}
    for d, t in docs:
        w = np.array(fold(t) or [b""], object)
        n = len(fold(t))
        for i, s in items:
            v = np.array(fold(s) or [b""], object)
            m = len(fold(s))
            if m == 0 or m < 3 and fold(t) != fold(s):
                continue
            width = min(least, m)
            # Fewer than 7 words: all of them; else the share.
            need = width if width < 7 else -(-round(share * 100) * width // 100)
            for g in range(-m + 1, n):
                low, high = max(0, -g), min(m, n - g)
                if high - low < width:
                    continue
                same = v[low:high] == w[low + g : high + g]
                if same.sum() < need:
                    continue
                c = np.concatenate([[0], np.cumsum(same)])
                good = np.flatnonzero(c[width:] - c[:-width] >= need)
                if len(good):
                    a, b = int(good[0]), int(good[-1]) + width
                    row = (low + a + g, low + a, b - a, int(c[b] - c[a]))
                    if (d, i) not in out or (row[3], -row[0]) > (out[d, i][3], -out[d, i][0]):
                        out[d, i] = row
    return out


def answer(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[:2] for r in rows}) == len(rows)
    return {r[:2]: r[2:] for r in rows}


def test_masks_miss_no_two_exchanged_words():
    for bad in itertools.combinations(range(decontam.OVERLAP), 2):
        assert any(
            all(start + k not in bad for k in mask)
            for mask in decontam.MASKS
            for start in range(decontam.OVERLAP - mask[-1])
        )


def made(seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(r.randint(1, 40)))) for i in range(25)] + [(98, None), (99, "")]
    docs = []
    for d in range(60):
        parts = [word() for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            copy = [word() if r.random() < 0.12 else w for w in (r.choice(items)[1] or "").split()]
            at = r.randint(0, len(parts))
            parts[at:at] = copy
        docs.append((d, " ".join(p.upper() if r.random() < 0.2 else p for p in parts)))
    return docs + [(100, None), (101, "")], items


def test_equals_brute_force(spark):
    docs, items = made(4)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert want and answer(decontam.contamination(df, bench)) == want
    assert answer(decontam.contamination(df, bench, block_bytes=600)) == want


def test_items_of_every_length(spark):
    """Items of 1 to 40 words, copied whole or with exchanged words, between other words or alone."""
    r = random.Random(9)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 41)]
    docs = []
    for n, text in items:
        for bad in range(5):
            words = text.split()
            for k in r.sample(range(n), min(bad, n)):
                words[k] = "other"
            docs.append((100 * n + bad, " ".join(words if bad % 2 else ["before", "it", *words, "after"])))
        docs.append((100 * n + 9, text.upper()))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    found = {(d // 100, d % 100) for d, _ in want}
    assert {(1, 9), (2, 9), (3, 0), (5, 0), (8, 1), (10, 2), (40, 2)} <= found and not {(1, 0), (5, 1), (9, 2)} & found
    assert answer(decontam.contamination(df, bench)) == want
    for least, share in ((13, 0.9), (8, 0.8), (20, 0.8), (6, 1.0)):
        assert answer(decontam.contamination(df, bench, overlap=least, share=share)) == brute(docs, items, least, share)
    with pytest.raises(ValueError):
        decontam.contamination(df, bench, overlap=13, share=0.6)


def test_table(spark, sf_dir):
    docs = [tuple(r) for r in queries.texts(spark, sf_dir).orderBy("doc_id").collect()]
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    got = answer(queries.op10_decontamination(spark, sf_dir))
    some = [(d, t) for d, t in docs if len(t) < 4000][:80]
    names = {d for d, _ in some}
    assert {k: v for k, v in got.items() if k[0] in names} == brute(some, items)


def test_edges(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id bigint, text string")
    assert decontam.contamination(docs, bench).collect() == []
    rows = spark.createDataFrame(
        [(None, "x A b c d e f g h", 1), (2, "a b c d e f g x", 1), (3, "a b c d e f g h", 2), (3, "a b c d e f g h", 3)],
        "doc_id bigint, text string, item_id int",
    )
    got = sorted(tuple(r) for r in decontam.contamination(rows, bench).fillna(-1).collect())
    assert got == [(-1, 1, 1, 0, 8, 8), (2, 1, 0, 0, 8, 7), (3, 1, 0, 0, 8, 8), (3, 1, 0, 0, 8, 8)]
    assert decontam.contamination(rows, bench.limit(0)).collect() == []
