"""Builds that stop and go on, and corpora that grow."""


import pytest
from pyspark.sql import functions as F

from quillsieve.__main__ import main
from quillsieve.functions.reporting import shard_number
from quillsieve.operators import packing
from quillsieve.plans import build
from quillsieve.sources import manifest
from quillsieve.sources.stagestore import StageStore, fingerprint

SUBSETS = {"a": [], "b": [], "c": []}


def sources(spark, read):
    def source(name, rows):
        return build.Source(name, "v1", lambda: read(name, rows))

    rows = spark.range(90).select(
        F.col("id").alias("row_id"), F.concat(F.lit("a document that is long enough to be kept, number "), "id").alias("text"),
        F.lit("x").alias("audience"), F.lit(10).cast("bigint").alias("text_token_length"),
    )
    parts = [
        source(name, rows.where(F.col("row_id") % 3 == n).withColumns({"subset": F.lit(name), "ord": F.lit(n)}))
        for n, name in enumerate(SUBSETS)
    ]
    books = spark.range(8).select(F.col("id").alias("book_id"), F.concat(F.repeat(F.lit("page "), 60), "id").alias("raw"))
    return parts, [source(f"shelf{n}", books.where(F.col("book_id") % 2 == n)) for n in (0, 1)]


def corpus(store, parts, books):
    return build.resumable_corpus(store, parts, books, target_tokens=1000, subsets=SUBSETS, shard_chars=900, group_rows=4)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("shard", "doc_id", "copy", "text").collect())


def test_killed_after_each_stage(spark, tmp_path):
    parts, books = sources(spark, lambda name, rows: rows)
    want = rows_of(corpus(StageStore(spark, str(tmp_path / "whole")), parts, books))
    # 700 tokens: the third subset is cut.
    assert sum(r[1].startswith("e:2") and r[2] == 0 for r in want) == 10
    plain = build.build_corpus(
        parts[0].read().union(parts[1].read()).union(parts[2].read()), books[0].read().union(books[1].read()),
        1000, subsets=SUBSETS, shard_chars=900, group_rows=4,
    )
    assert rows_of(plain) == want

    store, finished = StageStore(spark, str(tmp_path / "stopped")), []

    class Killed(Exception):
        pass

    class Stopping(StageStore):
        def run(self, name, key, make, tokens=None):
            if not self.has(name, key):
                if self.stop == 0:
                    raise Killed
                self.stop -= 1
            return super().run(name, key, make, tokens)

    def read(name, rows):
        assert name not in finished, f"{name} is read again"
        finished.append(name)
        return rows

    stopping = Stopping(spark, store.root)
    attempts = 0
    while True:
        stopping.stop = 1
        try:
            got = rows_of(corpus(stopping, *sources(spark, read)))
            break
        except Killed:
            attempts += 1
    assert got == want and attempts == 6
    entries = {r.stage: (r.rows, r.tokens) for r in store.entries().collect()}
    assert entries["educational a"] == (30, 300) and entries["educational c"] == (10, 100) and len(entries) == 7


def test_a_stage_appears_whole_or_not_at_all(spark, tmp_path):
    store = StageStore(spark, str(tmp_path / "s"))
    bad = spark.range(4).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        store.run("x", 1, lambda: bad)
    assert not store.has("x", 1) and store.entries().collect() == []
    # Another run finishes the same stage in between: its rows count.
    def late():
        store.run("x", 1, lambda: spark.range(2))
        return spark.range(5)

    assert store.run("x", 1, late).count == 2
    assert store.run("x", 1, late).rows.count() == 2 and store.run("x", 2, lambda: spark.range(0)).count == 0
    assert {tuple(r)[2:] for r in store.entries().collect()} == {(2, None), (0, None)}


def test_fingerprint(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    before = fingerprint(spark, str(tmp_path))
    assert fingerprint(spark, str(tmp_path)) == before
    (tmp_path / "b.txt").write_text("two")
    assert fingerprint(spark, str(tmp_path)) != before and fingerprint(spark, str(tmp_path), "a*") == before


def documents(spark, low, high):
    return spark.range(low, high).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("document number "), "id").alias("text"))


def live(spark, root):
    rows = manifest.scan(spark, root, "text string, is_pad boolean")
    return sorted(tuple(r) for r in rows.select(shard_number(F.col("_metadata.file_path")), "text", "is_pad").collect())


def one_run(spark, batches, target, group):
    """The same chain and padding by a plain loop."""
    keyed = []
    for n, batch in enumerate(batches):
        keyed += [(n, r.k, r.text) for r in sorted(batch.withColumn("k", F.md5(F.concat(F.lit("42:"), "doc_id"))).collect(), key=lambda r: r.k)]
    shards, chars = [[]], 0
    for *_, text in keyed:
        if chars >= target:
            shards.append([])
            chars = 0
        shards[-1].append(text)
        chars += len(text)
    import hashlib

    out = []
    for s, own in enumerate(shards):
        out += [(s, t, False) for t in own]
        for j in range(1, (-len(own)) % group + 1):
            out.append((s, own[int(hashlib.md5(f"{s}:{j}".encode()).hexdigest()[:8], 16) % len(own)], True))
    return sorted(out)


def test_appending_equals_one_run(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    batches = [documents(spark, 0, 40), documents(spark, 40, 41), documents(spark, 41, 41), documents(spark, 41, 130)]
    for n, batch in enumerate(batches):
        files = {p: p.stat().st_mtime_ns for p in (tmp_path / "c").rglob("*.parquet")}
        if n == 3:  # a run that dies first
            with monkeypatch.context() as patch:
                patch.setattr(manifest, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
                with pytest.raises(KeyboardInterrupt):
                    build.append_corpus(spark, root, batch, f"batch{n}", shard_chars=200, group_rows=4)
            assert live(spark, root) == one_run(spark, batches[:3], 200, 4)
        version = build.append_corpus(spark, root, batch, f"batch{n}", shard_chars=200, group_rows=4)
        assert build.append_corpus(spark, root, batch, f"batch{n}", shard_chars=200, group_rows=4) == version
        assert live(spark, root) == one_run(spark, batches[: n + 1], 200, 4)
        assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    closed = {r.shard: r.files for r in manifest.shards_at(spark, root, 1).collect()}
    now = {r.shard: r.files for r in manifest.shards_at(spark, root).collect()}
    assert sum(closed[s] == now[s] for s in closed) == len(closed) - 1
    assert [r.batch for r in manifest.batches(spark, root).orderBy("version").collect()] == ["batch0", "batch1", "batch3"]


def test_append_needs_flagged_pads(spark, tmp_path):
    from quillsieve.sources.shards import write_shards

    root = str(tmp_path / "c")
    write_shards(spark.createDataFrame([(0, "1", "text")], "shard bigint, shuffle_key string, text string"), root)
    with pytest.raises(Exception, match="does not flag"):
        build.append_corpus(spark, root, documents(spark, 0, 3), "b", shard_chars=100, group_rows=2)
    with pytest.raises(ValueError):
        packing.plan_shards(documents(spark, 0, 3), target=10, carry=10)


def test_jobs(spark, tmp_path, capsys):
    rows = spark.range(40).select(
        F.concat(F.lit("a story that is long enough to be kept in the corpus, number "), "id").alias("text"),
        F.lit("young_children").alias("audience"), F.col("id").alias("row_id"),
    )
    rows.write.parquet(str(tmp_path / "stories"))
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "pg5.txt").write_text("page " * 80)
    options = ["--books", f"{tmp_path}/books", "--target-tokens", "100000", "--shard-chars", "1500", "--pad-flag"]
    for name, more in (("plain", []), ("staged", ["--state", f"{tmp_path}/state"]), ("again", ["--state", f"{tmp_path}/state"])):
        main(["build", "--subset", f"stories={tmp_path}/stories", "--subset", f"stanford={tmp_path}/none", "--output", f"{tmp_path}/{name}", *options, *more])
        assert "skipped stanford" in capsys.readouterr().out
    plain, staged, again = ([tuple(r) for r in spark.read.parquet(f"{tmp_path}/{n}").select("shard", "text").orderBy("shard", "text").collect()] for n in ("plain", "staged", "again"))
    assert plain == staged == again and len({t for _, t in plain}) == 41
    rows.select(F.concat("text", F.lit(" appended")).alias("text")).write.parquet(f"{tmp_path}/more")
    for _ in range(2):
        main(["append", "--input", f"{tmp_path}/more", "--output", f"{tmp_path}/plain", "--batch", "more", "--shard-chars", "1500"])
        assert "version 1" in capsys.readouterr().out
    texts = {r.text for r in manifest.scan(spark, f"{tmp_path}/plain", "text string").collect()}
    assert len(texts) == 81
