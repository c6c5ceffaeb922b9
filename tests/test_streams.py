"""Streaming gate and quota, batch by batch, against their batch forms."""

import datetime

from pyspark.sql import functions as F

from quillsieve.operators import filters
from quillsieve.plans.dialogues import pending_requests
from quillsieve.streaming import quota_stream, verdict_stream

T0 = datetime.datetime(2024, 1, 1)
DOCS, VERDICTS = "doc_id bigint, time timestamp, text string", "doc_id bigint, time timestamp, verdict string"


def minute(n):
    return T0 + datetime.timedelta(minutes=n)


def gate(spark, base, feed):
    """Runs the gate after each step of ``feed`` (documents, verdicts); all steps share one checkpoint."""
    for n, (docs, verdicts) in enumerate(feed):
        spark.createDataFrame(docs, DOCS).coalesce(1).write.mode("append").parquet(f"{base}/docs")
        spark.createDataFrame(verdicts, VERDICTS).coalesce(1).write.mode("append").parquet(f"{base}/verdicts")
        gated = verdict_stream.gate_stream(
            spark.readStream.schema(DOCS).parquet(f"{base}/docs"), spark.readStream.schema(VERDICTS).parquet(f"{base}/verdicts"), "doc_id"
        )
        verdict_stream.run_gate(gated, f"{base}/out", f"{base}/checkpoint")
        yield (
            {(r.doc_id, r.is_safe) for r in verdict_stream.decisions(spark, f"{base}/out", DOCS).collect()},
            {(r.late_key, r.late_verdict) for r in verdict_stream.late_verdicts(spark, f"{base}/out").collect()},
        )


def test_gate_over_batches(spark, tmp_path):
    feed = [
        ([(1, minute(0), "a"), (2, minute(0), "b"), (3, minute(1), "c")], [(1, minute(0), " Safe\n"), (1, minute(1), "unsafe")]),
        ([(4, minute(5), "d"), (5, minute(5), None)], [(2, minute(4), "unsafe"), (4, minute(5), "safe")]),
        # The clock passes the patience of 3 and 5; their verdicts come too late.
        ([(None, minute(30), None)], [(None, minute(30), None)]),
        ([(6, minute(40), "f"), (None, minute(60), None)], [(3, minute(35), "safe"), (6, minute(41), None), (None, minute(60), None)]),
        ([(None, minute(90), None)], [(None, minute(90), None)]),
    ]
    seen = list(gate(spark, tmp_path, feed))
    assert seen[0] == ({(1, True)}, set())
    assert seen[1][0] == {(1, True), (2, False), (4, True)}
    final, late = seen[-1]
    assert final == {(1, True), (2, False), (3, False), (4, True), (5, False), (6, False)}
    assert late == {(3, "safe")}
    # The same rows through the batch gate, with the verdicts that came in time.
    docs = spark.createDataFrame([d for step in feed for d in step[0] if d[0]], DOCS)
    timely = spark.createDataFrame([(1, "safe"), (2, "unsafe"), (4, "safe"), (6, None)], "doc_id bigint, verdict string")
    assert {(r.doc_id, r.is_safe) for r in filters.verdict_gate(docs, timely, "doc_id").collect()} == final


def test_quota_stops_in_mid_batch(spark, tmp_path):
    kind = "task_id string, messages string"
    base = str(tmp_path)

    def feed(low, high):
        spark.createDataFrame([(str(n % 25), f"m{n}") for n in range(low, high)], kind).repartition(2).write.mode("append").parquet(f"{base}/in")

    def run(target):
        source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        return quota_stream.accept_stream(source, lambda b: b.where("task_id <> '3'"), f"{base}/out", f"{base}/cp", target)

    feed(0, 7)
    assert run(10) == 6
    feed(7, 60)
    assert run(10) == 10 and run(10) == 10
    feed(60, 70)
    assert run(10) == 10 and run(18) == 10
    feed(70, 140)
    assert run(18) == 18
    rows = quota_stream.accepted_so_far(spark, f"{base}/out", kind).collect()
    assert len({r.task_id for r in rows}) == len(rows) == 18 and "3" not in {r.task_id for r in rows}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    kind = "task_id string, messages string"
    out = str(tmp_path / "out")
    first, second = (spark.createDataFrame([(str(n), "m") for n in r], kind) for r in (range(0, 6), range(3, 30)))
    assert quota_stream.accept_batch(first, 0, out, 10, "task_id", kind) == 6
    assert quota_stream.accept_batch(second, 1, out, 10, "task_id", kind) == 10
    before = sorted(r.task_id for r in quota_stream.accepted_so_far(spark, out, kind).collect())
    assert quota_stream.accept_batch(second, 1, out, 10, "task_id", kind) == 10
    assert sorted(r.task_id for r in quota_stream.accepted_so_far(spark, out, kind).collect()) == before
    # A folder that was not finished doesn't count.
    (tmp_path / "out" / "batch=000000002").mkdir()
    assert quota_stream.accepted_so_far(spark, out, kind).count() == 10


def test_pending_requests(spark):
    topics = spark.createDataFrame([("a", "magnets"), ("b", "rain")], "topic_id string, topic string")
    finished = spark.createDataFrame([("a:2",), ("b:1",), ("b:1",)], "task_id string")
    rows = pending_requests(topics, finished, target=5, variations=3).collect()
    assert len(rows) == 3 and sorted(r.pos for r in rows) == [0, 1, 2]
    assert {r.task_id for r in rows} <= {"a:1", "a:3", "b:2", "b:3"}
    assert pending_requests(topics, finished, target=2, variations=3).collect() == []
    everything = pending_requests(topics, finished.limit(0), target=100, variations=3)
    assert everything.agg(F.countDistinct("task_id")).first()[0] == 6
