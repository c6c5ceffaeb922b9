from pyspark.sql import functions as F

from quillsieve.functions.patterns import Term, TermList
from quillsieve.operators import audit, filters
from quillsieve.plans.audit import audit_corpus, rewrite_dirty

TERMS = TermList.of([Term(0, "badword"), Term(1, "worse", "", True)])


def test_audience_rules(spark):
    rows = [
        (1, "a", " Kids "), (2, "a", "adults"), (3, "a", None), (4, "b", None), (5, "c", "kids"),
        (6, "d", "x"), (7, None, "kids"), (8, "a", " KIDS　"),
    ]
    df = spark.createDataFrame(rows, "i int, subset string, audience string")
    rules = {"a": ["Kids"], "b": [], "d": None}
    kept = filters.audience_filter(df, rules)
    assert sorted(r.i for r in kept.collect()) == [1, 4, 6, 8]


def test_audience_rule_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = filters.audience_filter(df, {"src1": [], "src2": ["en"]}, "source", "lang").select("doc_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(source" in text and "text" not in text.split("ReadSchema")[1].split("\n")[0]


def test_verdict_is_fail_closed(spark):
    docs = spark.createDataFrame([(i,) for i in range(6)], "doc_id int")
    verdicts = spark.createDataFrame(
        [(0, "safe"), (1, " Safe\n"), (2, "unsafe"), (3, None), (4, "safe ok")], "doc_id int, verdict string"
    )
    got = {r.doc_id: r.is_safe for r in filters.verdict_gate(docs, verdicts, "doc_id").collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: False, 5: False}


def test_score_gate_is_strictly_greater(spark):
    df = spark.createDataFrame([(0, 0.3, 0.1), (1, 0.31, 0.0), (2, None, 0.5), (3, 0.0, 0.51)], "i int, a double, b double")
    assert sorted(r.i for r in filters.score_gate(df, {"a": 0.3, "b": 0.5}).collect()) == [0, 2]


def test_layers_report_the_first_rejecting(spark):
    df = spark.createDataFrame([(1, True, True), (2, False, True), (3, False, None)], "i int, a boolean, b boolean")
    gated = filters.layered_gate(df, [("one", F.col("a")), ("two", F.col("b"))])
    assert {r.i: r.rejected_by for r in gated.collect()} == {1: "one", 2: "two", 3: None}


def test_audit_summary_adds_up(spark):
    rows = [("s1", "fine"), ("s1", "b4dw0rd"), ("s2", "worse"), ("s2", "worsen"), ("s3", None)]
    df = spark.createDataFrame(rows, "shard string, text string")
    got = {r.shard: tuple(r)[1:] for r in audit.audit_summary(df, TERMS).collect()}
    assert got == {"s1": (2, 1, 1, 1024), "s2": (2, 1, 1, 1024), "s3": (1, 0, 1, 1024), None: (5, 2, 3, 3072)}


def test_audit_never_shuffles_texts(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("source", "shard")
    counts = audit.audit_counts(df.withColumn("blocked", F.lit(False)))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ReadSchema: struct<source:string>" in plan


def test_emptied_shard_reports_zero(spark):
    df = spark.createDataFrame([("s", "badword")], "shard string, text string")
    assert [tuple(r) for r in audit.audit_counts(audit.mark_blocked(df, TERMS)).collect()] == [("s", 1, 1, 0, 0)]


def test_audit_log_names_stage_and_evidence(spark):
    rows = [(1, "a badword and a phrase"), (2, "only a phrase"), (3, "clean"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {tuple(r) for r in audit.audit_log(df, TERMS, ["a phrase"]).collect()}
    assert got == {(1, "blocklist", "badword"), (2, "phrase", "a phrase")}


def test_audit_plan_drops_old_pads_and_repads(spark):
    rows = [(i, "s", f"text {i}" if i else "badword", False, 0) for i in range(10)]
    rows += [(3, "s", "text 3", True, 1)]
    df = spark.createDataFrame(rows, "doc_id int, shard string, text string, is_pad boolean, copy int")
    result = audit_corpus(df, TERMS, ["text 9"], group_rows=4)
    kept = result.kept.collect()
    assert len(kept) == 8 and {r.doc_id for r in kept if not r.is_pad} == set(range(1, 9))
    assert [tuple(r) for r in result.counts.collect()] == [("s", 10, 2, 8, 1024)]
    assert {r.doc_id for r in result.log.collect()} == {0, 9}


def test_rewrite_touches_dirty_shards_only(spark):
    rows = [(1, "s1", "has phrase"), (2, "s1", "ok"), (3, "s2", "ok"), (4, "s3", "has phrase")]
    df = spark.createDataFrame(rows, "doc_id int, shard string, text string")
    out = rewrite_dirty(df, ["phrase"], group_rows=4).collect()
    assert {r.doc_id for r in out} == {2} and len(out) == 4


def test_flagged_matches_once(spark):
    listed = TermList.of([Term(1, "badword")])
    df = spark.createDataFrame([(1, "a badword"), (2, "clean"), (3, None)], "doc_id bigint, text string")
    found = filters.flagged(df, listed)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.doc_id for r in found.collect()] == [1]
