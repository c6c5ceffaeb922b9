import json
import datetime
import random

from pyspark.sql import functions as F

from quillsieve.functions.patterns import Term, TermList
from quillsieve.operators import dialogues as D
from quillsieve.plans.dialogues import accepted, request_table, screen_replies
from quillsieve.streaming import frames

U, A = {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}
GOOD = [U, A, U, A]


def parse(spark, replies):
    df = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    m = D.extract_messages(F.col("reply"))
    rows = df.withColumn("m", m).select("i", "m", D.messages_valid(F.col("m")).alias("ok")).collect()
    return [(r.m, r.ok) for r in sorted(rows, key=lambda r: r.i)]


def test_extraction_and_structure(spark):
    cases = {
        json.dumps(GOOD): True,
        "Here you go:\n" + json.dumps(GOOD, indent=1) + "\nBye": True,
        json.dumps(GOOD) + " and " + json.dumps(GOOD): False,
        "[1,2]": False,
        "[NaN]": False,
        "no array": False,
        "": False,
        json.dumps(GOOD[:3]): False,
        json.dumps([A, U, A, U]): False,
        json.dumps([{"role": "system", "content": "s"}] + GOOD): False,
        json.dumps(GOOD[:3] + [{"role": "user"}]): False,
        json.dumps(GOOD[:3] + [{"role": "user", "content": None}]): False,
        json.dumps([U, U, U, A]): True,
        json.dumps(GOOD * 5): True,
        "[" + json.dumps(GOOD)[1:-1] + ",]": False,
        "see ] [ " + json.dumps(GOOD): False,
        json.dumps(GOOD) + ', "w": [1]': False,
        json.dumps(GOOD) + "] , [" + json.dumps(GOOD): False,
        str(GOOD): False,
    }
    got = parse(spark, list(cases))
    assert [ok for _, ok in got] == list(cases.values())
    assert len(got[0][0]) == 4 and got[5][0] is None
    assert parse(spark, [None]) == [(None, False)]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string")


def test_long_form_rules_match_nested_rules(spark):
    rows = []
    for conv, roles in enumerate([["user", "assistant"] * 2, ["system", "user", "assistant", "user"], ["user"] * 3, ["user", "user", "x", "user"], ["user"] * 5]):
        rows += [(conv, i, role, f"t{i}") for i, role in enumerate(roles)]
    rows += [(9, i, "user", None if i == 2 else "x") for i in range(4)]
    random.Random(3).shuffle(rows)
    df = turns(spark, rows)
    long_form = {r.conv_id: r.is_valid for r in D.valid_conversations(df).collect()}
    nested = D.conversation_json(df).withColumn("m", D.extract_messages(F.col("messages")))
    nested_form = {r.conv_id: r.ok for r in nested.select("conv_id", D.messages_valid(F.col("m")).alias("ok")).collect()}
    assert long_form == nested_form == {0: True, 1: False, 2: False, 3: False, 4: True, 9: False}


def test_any_blocked_message_blocks_the_dialogue(spark):
    terms = TermList.of([Term(0, "bad", "", True)])
    df = turns(spark, [(1, 0, "user", "ok"), (1, 1, "assistant", "B4D!"), (2, 0, "user", "badge")])
    assert {r.conv_id: (r.blocked_messages, r.is_blocked) for r in D.blocked_conversations(df, terms).collect()} == {1: (1, True), 2: (0, False)}


def test_nothing_matches_across_messages(spark):
    terms = TermList.of([Term(0, "bad word"), Term(1, "end", "", True)])
    cases = [["a bad", "word"], ["bad", " word"], ["week", "end"], ["weekend"], ["bad word", "x"], [], None]
    rows = [(i, c and [("user", t) for t in c]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, m array<struct<role:string,content:string>>")
    got = [r.b for r in df.orderBy("i").select(D.messages_blocked(F.col("m"), terms).alias("b")).collect()]
    assert got == [False, False, True, False, True, False, False]


def test_joined_text_orders_long_keys(spark):
    n = 5000
    rows = [("k", i, str(i)) for i in range(n)] + [("other", 3, "x")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, n bigint, p string")
    got = {r.k: r.text for r in D.joined_text(df, "k", "n", F.col("p"), ",").collect()}
    assert got == {"k": ",".join(map(str, range(n))), "other": "x"}


def test_conversation_text(spark):
    df = turns(spark, [(1, 1, "assistant", "b"), (1, 0, "user", "a")])
    assert D.conversation_text(df).first().text == "user: a\nassistant: b"


def test_screening_statuses(spark):
    bad = [U, A, U, {"role": "assistant", "content": "worse"}]
    rows = [(1, json.dumps(GOOD)), (2, json.dumps(GOOD)), (3, json.dumps(bad)), (4, "none"), (5, json.dumps(GOOD))]
    replies = spark.createDataFrame(rows, "task_id int, reply string")
    verdicts = spark.createDataFrame([(1, "safe"), (2, "unsafe"), (3, "safe"), (4, "safe")], "task_id int, verdict string")
    out = screen_replies(replies, verdicts, TermList.of([Term(0, "worse")]))
    assert {r.task_id: r.status for r in out.collect()} == {1: "ok", 2: "rejected", 3: "rejected", 4: "failed", 5: "rejected"}
    assert [r.task_id for r in accepted(out).collect()] == [1]
    assert {r.status: r.dialogues for r in D.status_funnel(out).collect()} == {"ok": 1, "rejected": 3, "failed": 1}


def test_request_table(spark):
    topics = spark.createDataFrame([("t1", "magnets"), ("t2", "fossils")], "topic_id string, topic string")
    all_rows = request_table(topics, variations=5).collect()
    assert len(all_rows) == 10 and sorted(r.pos for r in all_rows) == list(range(10))
    row = next(r for r in all_rows if r.task_id == "t1:3")
    assert row.prompt == "Generate a tutoring conversation where a child asks about: magnets\nVariation 3: Make it feel unique and natural."
    rest = request_table(topics, existing=4, target=7, variations=5).collect()
    assert sorted(r.pos for r in rest) == [4, 5, 6]


LINES = [
    ": comment", 'data: {"token": "Hel"}', 'data:{"token":"lo","gpu":1}', "data: [DONE]", 'data: {"token": "', "",
    'event: x', '  data: {"token": " w"}  ', 'data: {"token": ""}', 'data: {"done": true}', 'data: {"token": "é\\n"}',
    'xdata: {"token": "no"}', "data: null", "data: 3", 'data: {"token":"no"} x', 'data: {"token":"no"},{"token":"no"}', 'data: {"token": null}',
]


def test_frames(spark):
    df = spark.createDataFrame([("s", i, l) for i, l in enumerate(LINES)] + [("empty", 0, "data: [DONE]")], "stream_id string, seq bigint, line string")
    got = {r.stream_id: r.text for r in frames.reassemble(df).collect()}
    assert got == {"s": "Hello wé\n", "empty": ""}


def test_streams_end_and_lost_lines_are_passed(spark, tmp_path):
    """A stream with a lost line is flushed after its patience, as in the batch form; repeats after the end are ignored."""
    kind = "stream_id string, seq bigint, line string, at timestamp"
    start = datetime.datetime(2024, 1, 1)
    later = start + datetime.timedelta(hours=1)
    lost = [("lost", i, f'data: {{"token": "w{i}"}}', start) for i in (0, 1, 3, 4, 6)]
    whole = [("whole", i, f'data: {{"token": "v{i}"}}', start) for i in range(3)] + [("whole", 3, "data: [DONE]", start)]
    other = [("other", 0, 'data: {"token": "x"}', later)]
    source = str(tmp_path / "in")

    def run(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        query = (
            frames.reassemble_stream(stream, event_time="at")
            .writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
            .format("parquet").start(str(tmp_path / "out"))
        )
        query.awaitTermination(120)
        query.stop()

    run(lost + whole)
    run(whole[1:3])
    run(other)
    run(other)
    pieces = spark.read.parquet(str(tmp_path / "out"))
    got = {r.stream_id: r.text for r in D.joined_text(pieces, "stream_id", "from_seq", F.col("piece")).collect()}
    batch = frames.reassemble(spark.createDataFrame(lost + whole + other, kind).drop("at"))
    assert got == {r.stream_id: r.text for r in batch.collect()}
    assert got["lost"] == "w0w1w3w4w6" and got["whole"] == "v0v1v2"


def test_streaming_frames_with_disorder_and_repeats(spark, tmp_path):
    """Lines of one stream spread over several micro-batches, out of order and partly twice."""
    rows = [("a", i, f'data: {{"token": "{i},"}}') for i in range(40)] + [("b", i, l) for i, l in enumerate(LINES)]
    random.Random(4).shuffle(rows)
    rows += rows[:10]
    source = str(tmp_path / "in")
    for part in range(4):
        chunk = rows[part::4]
        spark.createDataFrame(chunk, "stream_id string, seq bigint, line string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("stream_id string, seq bigint, line string").option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        frames.reassemble_stream(stream).writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).format("parquet").start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    pieces = spark.read.parquet(str(tmp_path / "out"))
    got = {r.stream_id: r.text for r in D.joined_text(pieces, "stream_id", "from_seq", F.col("piece")).collect()}
    assert got == {"a": "".join(f"{i}," for i in range(40)), "b": "Hello wé\n"}
