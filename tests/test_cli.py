"""The jobs chained on small folders, as a user would run them."""

import json

import pytest
from pyspark.sql import functions as F

from quillsieve.__main__ import main
from quillsieve.sources import manifest


@pytest.fixture
def folder(spark, tmp_path):
    def write(name, rows):
        path = tmp_path / name
        path.write_text("".join(json.dumps(row) + "\n" for row in rows))
        return str(path)

    write("terms.jsonl", [{"ord": 0, "term": "badword", "category": "x", "whole_word": False}])
    stories = spark.range(60).select(
        F.col("id").alias("row_id"),
        F.concat(F.lit("a story that is long enough to be kept in the corpus, number "), "id", F.when(F.col("id") % 20 == 0, " badword").otherwise("")).alias("text"),
        F.lit("young_children").alias("audience"),
    )
    stories.write.parquet(str(tmp_path / "stories"))
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "pg5.txt").write_text("head *** START OF THE PROJECT GUTENBERG EBOOK *** " + "page " * 80 + "torture")
    return tmp_path, write


def texts(spark, path):
    return [r.text for r in spark.read.parquet(str(path)).collect()]


def test_build_audit_rewrite_validate_report(spark, folder, capsys):
    base, _ = folder
    main(["build", "--subset", f"stories={base}/stories", "--subset", f"stanford={base}/none", "--books", f"{base}/books", "--output", f"{base}/shards", "--target-tokens", "100000", "--shard-chars", "2500", "--pad-flag"])
    assert "skipped stanford" in capsys.readouterr().out
    built = texts(spark, base / "shards")
    assert len(set(built)) == 61 and len(built) % 1024 == 0

    main(["validate", "--input", f"{base}/shards"])
    assert "all valid: True" in capsys.readouterr().out

    main(["audit", "--input", f"{base}/shards", "--output", f"{base}/clean", "--terms", f"{base}/terms.jsonl"])
    clean = set(texts(spark, base / "clean"))
    assert len(clean) == 58 and not any("badword" in t for t in clean)
    log = spark.read.json(f"{base}/clean-log")
    assert log.count() == 3 and {r.matched for r in log.collect()} == {"badword"}

    main(["rewrite", "--input", f"{base}/clean", "--output", f"{base}/second"])
    second = texts(spark, base / "second")
    assert second and not any("torture" in t for t in second)
    assert spark.read.parquet(f"{base}/second").select("shard").distinct().count() == 1

    before = {r.shard for r in manifest.shards_at(spark, f"{base}/clean").collect()}
    main(["rewrite", "--input", f"{base}/clean", "--publish"])
    assert "published version 1" in capsys.readouterr().out
    assert {r.shard for r in manifest.shards_at(spark, f"{base}/clean").collect()} == before
    left = [r.text for r in manifest.scan(spark, f"{base}/clean", "text string").collect()]
    assert len(left) % 1024 == 0 and not any("torture" in t for t in left) and len(set(left)) == 57
    main(["rewrite", "--input", f"{base}/clean", "--publish"])
    assert "nothing to change" in capsys.readouterr().out
    main(["validate", "--input", f"{base}/clean"])
    main(["vacuum", "--input", f"{base}/clean", "--min-age-hours", "0"])
    assert "deleted 1 files" in capsys.readouterr().out

    main(["stats", "--input", f"{base}/clean", "--output", f"{base}/report"])
    report = json.loads(spark.read.text(f"{base}/report").first().value)
    assert report["num_shards"] == len(report["shards"]) and report["total_docs"] % 1024 == 0


def test_incremental_audit_job(spark, folder):
    base, _ = folder
    for shard in (0, 1):
        spark.createDataFrame([(f"text {shard}",), ("badword",)], "text string").coalesce(1).write.parquet(f"{base}/src{shard}")
    (base / "flat").mkdir()
    for shard in (0, 1):
        (part,) = (base / f"src{shard}").glob("*.parquet")
        (base / "flat" / f"shard_{shard:05d}.parquet").write_bytes(part.read_bytes())
        before = {f: f.stat().st_mtime_ns for f in (base / "inc").glob("shard=*/*.parquet")}
        main(["audit-new", "--input", f"{base}/flat", "--output", f"{base}/inc", "--terms", f"{base}/terms.jsonl"])
        assert set(texts(spark, base / "inc")) == {f"text {s}" for s in range(shard + 1)}
        after = {f: f.stat().st_mtime_ns for f in (base / "inc").glob("shard=*/*.parquet")}
        assert before.items() <= after.items() and len(after) == shard + 1


def test_flat_shard_folder(spark, folder, capsys):
    """Shard files side by side, as other tools write them; a name without a number is an error."""
    base, _ = folder
    (base / "flat").mkdir()
    for shard in (0, 7):
        spark.createDataFrame([(f"text {shard}",), ("badword",)], "text string").coalesce(1).write.parquet(f"{base}/one{shard}")
        (part,) = (base / f"one{shard}").glob("*.parquet")
        (base / "flat" / f"shard_{shard:05d}.parquet").write_bytes(part.read_bytes())
    main(["audit", "--input", f"{base}/flat", "--output", f"{base}/kept", "--terms", f"{base}/terms.jsonl"])
    kept = {(r.shard, r.text): r.n for r in spark.read.parquet(f"{base}/kept").groupBy("shard", "text").agg(F.count("*").alias("n")).collect()}
    assert kept == {(0, "text 0"): 1024, (7, "text 7"): 1024}
    assert '"removed":1' in capsys.readouterr().out
    with pytest.raises(Exception, match="no shard number"):
        main(["audit", "--input", f"{base}/one0", "--output", f"{base}/none", "--terms", f"{base}/terms.jsonl"])


def test_build_numbers_rows_without_ids(spark, folder):
    base, _ = folder
    spark.read.parquet(f"{base}/stories").drop("row_id").write.parquet(f"{base}/plain")
    main(["build", "--subset", f"stories={base}/plain", "--books", f"{base}/books", "--output", f"{base}/built", "--target-tokens", "100000", "--shard-chars", "2500"])
    rows = spark.read.parquet(f"{base}/built")
    assert len({r.text for r in rows.select("text").collect()}) == 61 and rows.select("shard").distinct().count() > 1


def test_dialogue_jobs(spark, folder):
    base, write = folder
    topics = write("topics.jsonl", [{"topic_id": "t", "topic": "magnets"}])
    main(["requests", "--topics", topics, "--output", f"{base}/requests", "--variations-per-topic", "3", "--existing", "1"])
    assert spark.read.json(f"{base}/requests").count() == 2
    good = [{"role": r, "content": "fine"} for r in ("user", "assistant", "user", "assistant")]
    bad = good[:3] + [{"role": "assistant", "content": "b4dword"}]
    replies = write("replies.jsonl", [{"task_id": "1", "reply": "ok " + json.dumps(good)}, {"task_id": "2", "reply": json.dumps(bad)}])
    verdicts = write("verdicts.jsonl", [{"task_id": "1", "verdict": "safe"}, {"task_id": "2", "verdict": "safe"}])
    main(["screen", "--replies", replies, "--verdicts", verdicts, "--terms", f"{base}/terms.jsonl", "--output", f"{base}/dialogues"])
    assert [json.loads(r.value) for r in spark.read.text(f"{base}/dialogues").collect()] == [good]
