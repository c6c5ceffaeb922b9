"""Near-duplicate groups against all pairs."""

import importlib
import random
import re

import numpy as np

from quillsieve.llm import minhash, queries


def brute(rows, width=5):
    sets = {}
    for d, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    names = [d for d in sorted(sets) if sets[d]]
    for n, a in enumerate(names):
        for b in names[:n]:
            x, y = sets[a], sets[b]
            if 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_chains_and_copies(spark):
    r = random.Random(5)
    rows, d = [], 0
    for _ in range(25):
        words = [f"w{r.randrange(500)}" for _ in range(r.randint(3, 150))]
        for _ in range(r.randint(1, 6)):
            rows.append((d * 37 % 1009, " ".join(words)))
            d += 1
            words = list(words)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = f"W{r.randrange(500)}"
    rows += [(2000, None), (2001, " \n"), (2002, "A b"), (2003, "a\tB"), (2004, "a b c d"), (2005, rows[0][1].upper())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert answer(minhash.near_duplicates(df)) == brute(rows)


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.texts(spark, sf_dir).collect()]
    assert answer(queries.op7_minhash(spark, sf_dir)) == brute(rows)


def test_edges(spark):
    kind = "doc_id bigint, text string, bands int, component_id string"
    assert minhash.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    rows = [(None, "a b", 1, "x"), (None, "a b", 1, "x"), (4, "a b", 1, None), (4, "a b", 2, None)]
    got = sorted(tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, kind)).fillna(-1).collect())
    assert got == [(-1, 1, -1, True)] * 2 + [(4, 1, 4, True)] * 2


def test_links_within_a_family_below_the_threshold(spark):
    """Templated texts at similarity 0.72 share most buckets; only few pairs of them, at 0.77, are linked."""
    r = random.Random(11)
    ids = r.sample(range(10_000), 240)
    words = {d: [f"t{k}" for k in range(84)] + [f"{d}-{k}" for k in range(16)] for d in ids}
    for one, two in zip(ids[:60:2], ids[1:60:2]):
        words[two][84:87] = words[one][84:87]
    rows = [(d, " ".join(w)) for d, w in words.items()]
    want = brute(rows, 1)
    assert sum(not kept for _, _, kept in want.values()) == 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert answer(minhash.near_duplicates(df, width=1)) == want


def test_families_and_outsiders(spark):
    """A large component, outsiders near it, and families at 0.68 to 0.8 whose members keep varying parts of a template."""
    r = random.Random(23)
    base = [f"b{k}" for k in range(120)]
    rows, d = [], 0
    for _ in range(120):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(120)] = f"x{r.randrange(10**6)}"
        rows.append((d, " ".join(words)))
        d += 1
    for keep in (80, 86, 90, 93, 96):
        for _ in range(25):
            words = sorted(r.sample(range(120), keep))
            rows.append((d, " ".join([base[k] for k in words] + [f"y{d}-{k}" for k in range(r.randint(2, 120 - keep))])))
            d += 1
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows, 1)
    assert 1 < sum(kept for _, _, kept in want.values()) < len(rows)
    assert answer(minhash.near_duplicates(df, width=1)) == want


def test_pairs_of_a_family_grow_with_it(spark, monkeypatch):
    """Templated texts below the threshold: the rows that meet in a prefix are few, at any size of the family."""
    made = []
    plain = minhash._across
    monkeypatch.setattr(minhash, "_across", lambda prefixes: made.append((prefixes.count(), plain(prefixes).count())) or plain(prefixes))
    for count in (150, 600):
        rows = [(d, " ".join([f"t{k}" for k in range(84)] + [f"{d}-{k}" for k in range(16)])) for d in range(count)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        assert minhash.near_duplicates(df, width=1).where("kept").count() == count
    assert made == [(0, 0), (0, 0)]


def test_one_id_with_several_texts(spark):
    """Texts that share nothing aren't joined through a doc_id; copies under one id stay together."""
    one, two = (" ".join(f"{c}{n}" for n in range(40)) for c in "pq")
    rows = [(7, one), (8, two), (5, one), (5, two), (5, two), (9, "long " * 300_000), (10, "LONG " * 300_001), (11, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, node int, component string").repartition(3)
    got = sorted(tuple(r) for r in minhash.near_duplicates(df).collect())
    assert got == [(5, 36, 5, True)] * 3 + [(7, 36, 5, False), (8, 36, 5, False), (9, 1, 9, True), (10, 1, 9, False), (11, 0, 11, True)]


def test_registers_merge_and_estimate():
    r = np.random.default_rng(3)
    pool = r.integers(0, 2**63, 4000, dtype=np.uint64)
    one, two = pool[:2500], pool[500:]
    rows = minhash.sketches(np.concatenate([one, two, pool]), np.array([len(one), len(two), len(pool)]))
    assert (np.maximum(rows[0], rows[1]) == rows[2]).all()
    above, below = (rows[0] > rows[1]).sum(), (rows[0] < rows[1]).sum()
    got = minhash.estimate(*(np.array([x]) for x in (above, below, 128 - above - below, 2500.0, 3500.0)))
    assert abs(got[0] - 0.5) < 0.15


def test_bucket_compared_with_its_first_is_closed(spark):
    members = spark.createDataFrame(
        [(1, 10, 20, 10), (1, 11, 20, 10), (2, 10, 20, 10), (2, 11, 20, 10), (2, 12, 20, 10)],
        "band bigint, node bigint, n_shingles bigint, first bigint",
    )
    parts = spark.createDataFrame([], "id bigint, component bigint")
    left = minhash._open_buckets(members, parts)
    assert sorted((r.band, r.node, r.component) for r in left.collect()) == [(2, 11, 11), (2, 12, 12)]


def test_set_apart_meets_some_of_a_large_component_first(spark):
    rows = [(1, 1, 1, n, 20, 0) for n in range(1000)] + [(1, 1, 1, 5000 + n, 20, 0) for n in range(5)]
    prefixes = spark.createDataFrame(rows, "shingle bigint, small int, large int, node bigint, n_shingles bigint, place bigint")
    parts = spark.createDataFrame([(n, 0) for n in range(1000)], "id bigint, component bigint")
    meeting = minhash._meeting(prefixes.selectExpr("*", "node AS component"), parts)
    pairs = [tuple(r) for r in minhash._stars(meeting, 16, 0).collect()]
    assert 5 <= len(pairs) <= 5 * 16 and len(set(pairs)) == len(pairs)
    assert all(a < 1000 and b >= 5000 for a, b in pairs)
    assert minhash._across(meeting).count() == 5 * 1000 + 10


def test_new_links_join_components(spark, tmp_path):
    """Links walk the graph of the components; a node without a link so far becomes part of one."""
    spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "id bigint, component bigint").write.parquet(f"{tmp_path}/parts")
    spark.createDataFrame([(2, 6), (2, 5), (3, 9), (4, 7)], "a bigint, b bigint").write.parquet(f"{tmp_path}/links")
    got = minhash._merged(spark.read.parquet(f"{tmp_path}/parts"), spark.read.parquet(f"{tmp_path}/links")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 1), (6, 1), (7, 4), (8, 3), (9, 3)]


def test_rounds_store_few_tables(spark, monkeypatch):
    """Each stored table costs a job at all shuffle partitions, whatever its rows: all rounds together store no more than 65."""
    stored, plain = [], minhash.materialize
    for module in (minhash, importlib.import_module("quillsieve.llm.components")):
        monkeypatch.setattr(module, "materialize", lambda df, label="stage": stored.append(label) or plain(df, label))
    r = random.Random(23)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for d in range(120):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(120)] = f"x{r.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    for keep in (80, 86, 90, 93, 96):
        for d in range(len(rows), len(rows) + 25):
            words = sorted(r.sample(range(120), keep))
            rows.append((d, " ".join([base[k] for k in words] + [f"y{d}-{k}" for k in range(r.randint(2, 120 - keep))])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert answer(minhash.near_duplicates(df, width=1)) == brute(rows, 1)
    assert "prefixes" in stored and len(stored) <= 65
