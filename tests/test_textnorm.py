from pyspark.sql import functions as F

from quillsieve.functions import reporting, textnorm as tn


def column(spark, values, type_="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"i int, v {type_}")


def evaluate(spark, values, expr, type_="string"):
    rows = column(spark, values, type_).select("i", expr.alias("r")).collect()
    return [row.r for row in sorted(rows, key=lambda row: row.i)]


def test_strip_set_is_the_unicode_whitespace_set():
    assert set(tn.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_equals_python_for_every_low_code_point(spark):
    values = [f"{chr(i)}x {chr(i)}y{chr(i)}" for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    assert evaluate(spark, values, tn.strip(F.col("v"))) == [v.strip() for v in values]


def test_long_enough_thresholds_and_nulls(spark):
    values = [None, "", "\t\n", "a" * 49, "a" * 50, " " + "a" * 49 + "　", " " + "é" * 50, "b" * 200, "b" * 201]
    assert evaluate(spark, values, tn.long_enough(F.col("v"))) == [
        False, False, False, False, True, False, True, True, True
    ]
    books = evaluate(spark, values, tn.long_enough(F.col("v"), tn.MIN_BOOK_CHARS))
    assert books == [False] * 8 + [True]


def test_is_empty(spark):
    assert evaluate(spark, [None, "", "  \n", "x"], tn.is_empty(F.col("v"))) == [True, True, True, False]


def test_token_count_truncates_and_prefers_stored(spark):
    df = spark.createDataFrame([("x" * 47, None), ("x" * 48, None), ("x" * 48, 3), ("", None)], "t string, n int")
    got = [r.c for r in df.select(tn.token_count(F.col("t"), F.col("n")).alias("c")).collect()]
    assert got == [int(47 / 4.8), int(48 / 4.8), 3, 0]


def test_strip_boilerplate_marker_cases(spark):
    s, e = "*** START OF THE PROJECT GUTENBERG EBOOK A ***", "*** END OF THIS PROJECT GUTENBERG EBOOK A ***"
    split_marker = "h *** START OF THE PROJECT GUTENBERG EBOOK A\nB *** body"
    cases = {
        f"head\n{s}\nbody\n{e}\ntail": "body",
        f"head\n{s}\nbody": "body",
        f"body\n{e}\ntail": "body",
        "no markers\n\n\n\n\nat all": "no markers\n\n\nat all",
        "three\n\n\nstay": "three\n\n\nstay",
        f"h ***start of this project gutenberg ebook x*** body {e}": "body",
        split_marker: split_marker,
        f"{s} one {e} two {e} three": "one",
        f"{e} first {s} second": "second",
        f"a\r\n{s}\r\nline\r\n{e}\r\n": "line",
        f"{s}  x \u0085{e}": "x",
        "*** START OF THE PROJECT GUTENBERG EBOOK A\rB *** body": "body",
        f"{s} a {s} b {e}": f"a {s} b",
        "": "",
    }
    assert evaluate(spark, list(cases), tn.strip_boilerplate(F.col("v"))) == list(cases.values())


def test_strip_boilerplate_large_input(spark):
    raw = "x\n" * 1_000_000 + "*** START OF THE PROJECT GUTENBERG EBOOK A ***" + "y\n" * 1_000_000
    assert evaluate(spark, [raw], F.length(tn.strip_boilerplate(F.col("v")))) == [1_999_999]


def test_preview_and_shard_name(spark):
    assert evaluate(spark, ["a\nb", "x" * 400], tn.preview(F.col("v"))) == ["a b...", "x" * 300 + "..."]
    assert evaluate(spark, [7, 123456], tn.shard_name(F.col("v")), "int") == ["shard_00007", "shard_123456"]


def test_label_is_not_cut_and_bar_is_bounded(spark):
    label = evaluate(spark, [5, 123456789], reporting.grouped_number(F.col("v")), "bigint")
    assert label == [f"{5:>8,}", f"{123456789:>8,}"]
    bars = evaluate(spark, [0, 1, 50, 100, 500], reporting.bar(F.col("v"), F.lit(100)), "bigint")
    assert bars == ["", "", "#" * 25, "#" * 50, "#" * 50]
