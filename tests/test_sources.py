import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quillsieve.functions.patterns import Term, TermList
from quillsieve.operators import packing
from quillsieve.plans.build import build_corpus
from quillsieve.plans.report import report_json
from quillsieve.runtime import drop_stages, materialize, run_dir, shared_dir
from quillsieve.sources import documents, ledger, shards
from quillsieve.streaming import audit_stream

TERMS = TermList.of([Term(0, "badword")])


def make_shards(spark, path, n=2500, target=30_000, group=256):
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("document number "), "id").alias("text"))
    plan = packing.plan_shards(df, target=target)
    padded = packing.pad_shards(plan.assign(df), group_rows=group, sizes=plan.sizes(), whole_shards=True)
    shards.write_shards(padded, path, group_rows=group, clustered=True)
    return padded


def test_written_shards_have_the_fixed_shape(spark, tmp_path):
    path = str(tmp_path / "shards")
    make_shards(spark, path)
    files = sorted((tmp_path / "shards").glob("shard=*/*.parquet"))
    assert len({f.parent for f in files}) == len(files) >= 2
    for file in files:
        meta = pq.ParquetFile(file).metadata
        assert meta.schema.names == ["text"]
        assert {meta.row_group(i).num_rows for i in range(meta.num_row_groups)} == {256}
        column = meta.row_group(0).column(0)
        assert column.compression == "ZSTD" and "PLAIN_DICTIONARY" not in column.encodings and "RLE_DICTIONARY" not in column.encodings
    checked = shards.validate_shards(spark, path, group_rows=256).collect()
    assert all(r.ok for r in checked) and len(checked) == len(files)
    total = shards.all_valid(shards.validate_shards(spark, path, group_rows=256)).first()
    assert total.all_ok and total.rows % 256 == 0


def test_default_row_groups_hold_1024_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    make_shards(spark, path, n=3000, target=10**9, group=1024)
    (file,) = (tmp_path / "s").glob("shard=0/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [1024] * 3


def test_dynamic_rewrite_leaves_other_shards_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(s, str(i), f"text {s} {i}") for s in (0, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "shard bigint, shuffle_key string, text string")
    shards.write_shards(df, path)
    before = sorted(p.name for p in (tmp_path / "s" / "shard=0").iterdir())
    shards.write_shards(df.where("shard = 1").limit(2), path, mode="dynamic")
    assert sorted(p.name for p in (tmp_path / "s" / "shard=0").iterdir()) == before
    assert spark.read.parquet(path).groupBy("shard").count().orderBy("shard").collect()[1]["count"] == 2


def test_validation_reports_every_issue(spark, tmp_path):
    good = pa.table({"text": ["x"] * 10})
    pq.write_table(good, tmp_path / "a_good.parquet", row_group_size=4, compression="zstd")
    pq.write_table(pa.table({"text": ["x"] * 6}), tmp_path / "b_short.parquet", row_group_size=3, compression="zstd")
    pq.write_table(pa.table({"text": ["x", "  ", None, ""]}), tmp_path / "c_empty.parquet", compression="snappy")
    pq.write_table(pa.table({"other": ["x"]}), tmp_path / "d_other.parquet", compression="zstd")
    (tmp_path / "e_broken.parquet").write_bytes(b"not parquet")
    got = {r.name: r for r in shards.validate_shards(spark, str(tmp_path), group_rows=4).collect()}
    assert got["a_good.parquet"].ok and got["a_good.parquet"].row_groups == 3
    issues = {name: [tuple(i) for i in row.issues] for name, row in got.items()}
    assert issues["b_short.parquet"] == [("row_group", 0, "3", "4")]
    assert issues["c_empty.parquet"] == [("codec", None, "snappy", "zstd"), ("empty_docs", None, "3", "0")]
    assert issues["d_other.parquet"] == [("no_text", None, "other", "text")]
    assert [i[0] for i in issues["e_broken.parquet"]] == ["unreadable"]


def test_validation_sees_corrupt_pages(spark, tmp_path):
    """The footers are intact; files of one name lie in two folders."""
    rows = spark.range(3000).select(F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = str(tmp_path / "s")
    for folder in ("a", "b"):
        rows.select("text").coalesce(1).write.option("compression", "zstd").option("parquet.block.row.count.limit", 1024).parquet(f"{path}/{folder}")
        (file,) = (tmp_path / "s" / folder).glob("*.parquet")
        file.rename(file.with_name("shard_00000.parquet"))
    broken = tmp_path / "s" / "b" / "shard_00000.parquet"
    data = bytearray(broken.read_bytes())
    for at in range(len(data) // 4, len(data) // 2):
        data[at] ^= 0xFF
    broken.write_bytes(data)
    for crc in (tmp_path / "s").rglob(".*.crc"):
        crc.unlink()
    got = {r.path.split("/")[-2]: r for r in shards.validate_shards(spark, path).collect()}
    assert got["a"].ok and got["a"].rows == 3000
    assert not got["b"].ok and "lost_rows" in [i.code for i in got["b"].issues]


def test_no_shards_is_not_valid(spark, tmp_path):
    assert shards.all_valid(shards.validate_shards(spark, str(tmp_path))).first().all_ok is False


def test_scan_reads_only_text(spark, sf_dir):
    plan = shards.scan_shards(spark, sf_dir, "documents.parquet")
    assert "ReadSchema: struct<text:string>" in plan._jdf.queryExecution().executedPlan().toString()


def test_jsonl_and_counts(spark, tmp_path):
    path = str(tmp_path / "j")
    df = spark.createDataFrame([("a\n\"b\"",), ("é",)], "text string")
    documents.append_jsonl(df, path)
    documents.append_jsonl(df, path)
    assert sorted(r.text for r in documents.read_jsonl(spark, path).collect()) == ["a\n\"b\""] * 2 + ["é"] * 2
    (tmp_path / "lines.jsonl").write_text('{"a":1}\n\n  \n[]\n')
    assert documents.count_jsonl(spark, str(tmp_path / "lines.jsonl")).first().lines == 2


def test_dialogue_lines_are_arrays(spark, tmp_path):
    df = spark.createDataFrame([([("user", "a\nb")],)], "messages array<struct<role:string,content:string>>")
    documents.append_dialogues(df, str(tmp_path / "d"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "d")).collect()]
    assert [json.loads(l) for l in lines] == [[{"role": "user", "content": "a\nb"}]]


def test_books(spark, tmp_path):
    (tmp_path / "pg12.txt").write_bytes(b"one\r\ntwo\n")
    (tmp_path / "pg7.txt").write_text("é")
    (tmp_path / "notes.txt").write_text("no")
    got = {r.book_id: r.raw for r in documents.read_books(spark, str(tmp_path)).collect()}
    assert got == {12: "one\r\ntwo\n", 7: "é"}


def test_missing_subset_is_skipped(spark, tmp_path):
    spark.createDataFrame([("t",)], "text string").write.parquet(str(tmp_path / "ok"))
    rows, failed = documents.scan_subsets(spark, {"gone": str(tmp_path / "gone"), "ok": str(tmp_path / "ok")})
    assert [(r.subset, r["ord"], r.text, r.audience, r.text_token_length) for r in rows.collect()] == [("ok", 1, "t", None, None)]
    assert list(failed) == ["gone"]


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    work = spark.createDataFrame([("a", 5), ("a", 6), ("b", 1), ("c", 2)], "subset string, tokens bigint")
    assert ledger.outstanding(work, ledger.load(spark, path), "subset", "subset").count() == 4
    ledger.record(work.where("subset = 'a'"), path, "subset", "subset", "tokens")
    ledger.record(work.where("subset = 'c'"), path, "book", "subset")
    book = ledger.load(spark, path)
    assert [r.subset for r in ledger.outstanding(work, book, "subset", "subset").orderBy("subset").collect()] == ["b", "c"]
    assert {r.kind: (r["keys"], r.tokens) for r in ledger.progress(book).collect()} == {"subset": (1, 11), "book": (1, None)}


def test_incremental_audit_sees_each_file_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.createDataFrame([("fine",), ("a badword",)], "text string").coalesce(1).write.parquet(src)
    run = lambda: audit_stream.audit_new_shards(spark, src, out, cp, TERMS)
    totals = lambda: audit_stream.audited_counts(spark, out).agg(F.sum("total"), F.sum("removed")).first()
    run()
    assert tuple(totals()) == (2, 1)
    run()
    assert tuple(totals()) == (2, 1)
    spark.createDataFrame([("b4dw0rd",)], "text string").coalesce(1).write.mode("append").parquet(src)
    run()
    assert tuple(totals()) == (3, 2)


def test_build_plan_end_to_end(spark, tmp_path):
    edu = spark.createDataFrame(
        [("s1", 0, i, "kids" if i % 2 else "web", "word " * 40, 10 if i < 50 else None) for i in range(100)],
        "subset string, ord int, row_id bigint, audience string, text string, text_token_length bigint",
    )
    books = spark.createDataFrame([(i, f"head *** START OF THE PROJECT GUTENBERG EBOOK *** {'page ' * 60}") for i in range(20)], "book_id bigint, raw string")
    corpus = build_corpus(edu, books, target_tokens=1000, subsets={"s1": ["kids"]}, shard_chars=2000, group_rows=8)
    rows = corpus.collect()
    own = [r for r in rows if not r.is_pad]
    # 25 stored rows of 10 tokens, then estimates of 41 until 700 is reached.
    assert sum(r.doc_id.startswith("e") for r in own) == 25 + 11
    assert sum(r.doc_id.startswith("b") for r in own) == 5
    sizes = {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert all(n % 8 == 0 for n in sizes.values())
    chars = {}
    for r in own:
        chars[r.shard] = chars.get(r.shard, 0) + len(r.text)
    last = max(chars)
    assert all(n >= 2000 for s, n in chars.items() if s != last)


def test_report_over_written_shards(spark, tmp_path):
    path = str(tmp_path / "s")
    make_shards(spark, path, n=600, target=5000, group=64)
    report = json.loads(report_json(spark, path).first().report)
    assert report["num_shards"] == len(report["shards"]) >= 2
    assert report["total_docs"] == sum(s["docs"] for s in report["shards"])
    assert all(s["row_groups"] * 64 == s["docs"] for s in report["shards"])


def test_materialized_tables_live_in_the_shared_folder(spark):
    df = materialize(spark.range(3), "probe")
    assert df.count() == 3 and all(shared_dir(spark) in f for f in df.inputFiles())
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_stages_can_be_dropped(spark):
    df = materialize(spark.range(3), "probe")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert os.path.isdir(folder)
    drop_stages(spark)
    assert not os.path.exists(os.path.dirname(folder))
    assert materialize(spark.range(2), "probe").count() == 2
