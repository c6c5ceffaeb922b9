"""Merkle manifests against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quillsieve.llm import merkle, queries

KIND = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(hashes, fanout):
    """The root and, for each leaf, the runs it climbs through: (before, after) on every level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for n, place in enumerate(at):
            run, slot = runs[place // fanout], place % fanout
            paths[n].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        at = [place // fanout for place in at]
        level = [h("".join(run)) for run in runs]
    return level[0], paths


def brute(rows, fanout):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, encoded(r)))
        trees.append((own, *climb([encoded(r) for r in own], fanout)))
    root, tops = climb([t[1] for t in trees], fanout) if trees else (None, [])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for row, path in zip(own, paths):
            path = path + top
            changed = row
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                changed = (*row[:3], row[3] + 1, row[4])
            folded = encoded(changed)
            for before, after in path:
                folded = h(before + folded + after)
            out.append((row[0] or 0, encoded(row), subroot, root, h("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out)


def answer(df, fanout):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    more = merkle.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    touched = F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    df = df.withColumn("altered", F.when(touched, more))
    made = merkle.manifest(df, F.col("lang"), ["doc_id"], columns, ["doc_id", "altered"], fanout)
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("path"))
    got = made.select(F.coalesce("doc_id", F.lit(0)), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), folded.alias("f"))
    return sorted(tuple(r) for r in got.withColumn("v", F.col("f") == F.col("root")).collect())


def some_rows():
    rows = [(n * 31 % 97, f"s{n % 3}", ["en", "de", "é", None][n % 4 if n < 12 else 0], n, f"text {n}") for n in range(41)]
    rows += [(3, "s0", "en", 5, "same id, other text"), (None, None, None, None, None), (None, "x", "en", 1, "")]
    rows += [(50, "copy", "fr", 4, "again")] * 6 + [(7, "s", "lone", None, "a" * 300_000)]
    return rows


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_trees(spark, fanout):
    rows = some_rows()
    df = spark.createDataFrame(rows, KIND).repartition(5)
    assert answer(df, fanout) == brute(rows, fanout)


def test_edges(spark):
    assert answer(spark.createDataFrame([], KIND), 2) == []
    one = [(1, "s", None, 2, "lone")]
    assert answer(spark.createDataFrame(one, KIND), 2) == brute(one, 2)
    extra = spark.createDataFrame(one, KIND).withColumns({c: F.lit(9) for c in ("hash", "tree", "index", "nodes", "path", "_row", "before")})
    assert answer(extra, 2) == brute(one, 2)
    with pytest.raises(ValueError):
        merkle.manifest(extra, F.col("lang"), ["doc_id"], ["text"], ["path"])


def test_fields_are_not_ambiguous(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "-"), ("-", None), ("", None), (None, "")], "a string, b string")
    assert df.select(merkle.leaf_hash(F.col("a"), F.col("b")).alias("x")).distinct().count() == 6


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = queries.op13_merkle(spark, sf_dir)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 2)
