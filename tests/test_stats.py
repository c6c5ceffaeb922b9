import json
from collections import Counter

from pyspark.sql import functions as F

from quillsieve.operators import stats


def texts(spark, lengths):
    return spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "doc_id bigint, text string")


def expected_histogram(lengths, bins):
    if not lengths:
        return []
    low, high = min(lengths), max(lengths)
    width = (high - low) // bins or 1
    filled = Counter(min((n - low) // width, bins - 1) for n in lengths)
    firsts = [low + width * i for i in range(bins)]
    lasts = [first - 1 for first in firsts[1:]] + [high]
    return [(f"{a:>8,} - {z:>8,}", filled[i]) for i, (a, z) in enumerate(zip(firsts, lasts))]


def histogram(spark, lengths, bins=10):
    rows = stats.length_histogram(texts(spark, lengths), bins).orderBy("bin").collect()
    return [(r.label, r.docs) for r in rows]


def test_histogram_shapes(spark):
    for lengths in ([], [7] * 5, [1, 3, 4], list(range(0, 2000, 7)), [5, 12345], [0, 99]):
        for bins in (1, 10):
            assert histogram(spark, lengths, bins) == expected_histogram(lengths, bins), lengths


def test_histogram_null_text_is_not_counted(spark):
    df = spark.createDataFrame([(1, None), (2, "ab")], "doc_id bigint, text string")
    assert stats.length_histogram(df, 1).first().docs == 1


def test_totals_of_an_empty_corpus(spark):
    row = stats.corpus_totals(texts(spark, [])).first()
    assert (row.total_docs, row.total_chars, row.avg_chars) == (0, 0, 0.0)


def test_token_estimate(spark):
    df = spark.createDataFrame([(1, "one two, three"), (2, "four")], "doc_id bigint, text string")
    row = stats.token_estimate(df).first()
    assert (row.sample_chars, row.sample_tokens) == (18, 5)
    assert row.estimated_tokens == int(18 / (18 / 5))


def test_token_estimate_without_characters(spark):
    row = stats.token_estimate(texts(spark, [0, 0])).first()
    assert (row.estimated_tokens, row.chars_per_token) == (0, 4.8)


def test_token_estimate_takes_a_tokenizer(spark):
    row = stats.token_estimate(texts(spark, [10, 10]), tokens=lambda c: (F.length(c) / 2).cast("bigint")).first()
    assert row.chars_per_token == 2.0 and row.estimated_tokens == 10


def test_report_is_one_json_document(spark):
    shard_rows = [("b", 2, 20, 0.5, 1), ("a", 1, 10, 0.25, 1)]
    table = spark.createDataFrame(shard_rows, "name string, docs bigint, chars bigint, size_mb double, row_groups int")
    estimate = stats.token_estimate(texts(spark, [10, 10, 10]))
    report = json.loads(stats.corpus_report(table, estimate).first().report)
    assert report["total_docs"] == 3 and report["num_shards"] == 2
    assert report["avg_doc_length_chars"] == 10.0
    assert [s["name"] for s in report["shards"]] == ["a", "b"]
    assert set(report["shards"][0]) == {"name", "docs", "chars", "size_mb", "row_groups"}
