import random

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quillsieve.functions import patterns as P
from quillsieve.functions.matching import _compiled, _kernel, blocked, first_phrase
from quillsieve.functions.patterns import Term, TermList
from quillsieve.operators import audit, filters


def occurs(term, text):
    """Character-by-character search for one term, without regular expressions."""
    text = text.lower()

    def is_word(at):
        return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")

    def boundary(at):
        return is_word(at - 1) != is_word(at)

    for start in range(len(text) + 1):
        ends = {start}
        for letter in term.term:
            if letter == " ":
                for end in sorted(ends):
                    while end < len(text) and (text[end].isspace() or text[end] in "-_"):
                        end += 1
                        ends.add(end)
            else:
                accepted = P.SUBSTITUTIONS.get(letter, letter)
                ends = {end + 1 for end in ends if end < len(text) and text[end] in accepted}
        if term.whole_word:
            ends = {end for end in ends if boundary(start) and boundary(end)}
        if ends:
            return True
    return False


def python_first(terms, text):
    return next((term.term for term in terms.terms if occurs(term, text)), None)


def spark_first(spark, terms, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = filters.with_first_term(df, terms).collect()
    return [r.matched_term for r in sorted(rows, key=lambda r: r.i)]


TERMS = TermList.of(
    [
        Term(0, "zebra"), Term(1, "apple"), Term(2, "hill", "", True), Term(3, "sun set"),
        Term(4, "half-way"), Term(5, "été"), Term(6, "apples"), Term(7, "App"), Term(8, "cat", "", True),
        Term(9, "cats", "", True), Term(10, "a", "", True), Term(11, "tst", "", True), Term(12, "zébré"),
    ]
)

TEXTS = [
    "hello", "hill", "shill", "hills", "h1ll", "h!ll ok", "éhill", "hillé", "hill_", " hill.",
    "@pple", "4PPLE", "ápple", "app", "sunset", "sun  set", "sun-_set", "sun set", "sun.set",
    "half-way", "half way", "halfway", "ÉTÉ", "the zebra ate an apple", "an apple and a zebra",
    "cat", "cats", "kats", "c4t5", "concat", "@", " @ ", "x@x", "$un set", "the $t$ x", "7st", " 7s+ ", "7s+x",
    "zébré", "zébr3", "", "a b", "^", "x^x", "cat's", "1hill", "hill2",
]


def test_first_term_follows_list_order_and_boundaries(spark):
    assert spark_first(spark, TERMS, TEXTS) == [python_first(TERMS, t) for t in TEXTS]


def test_flags_agree_with_single_regexes(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS + [None]], "text string")
    got = [r.flag for r in df.select(blocked(F.col("text"), TERMS).alias("flag")).collect()]
    assert got == [bool(t is not None and python_first(TERMS, t)) for t in TEXTS + [None]]


def test_whole_word_term_with_outer_space_is_refused():
    with pytest.raises(ValueError):
        P.scan_patterns(Term(0, " a", "", True))


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.text("abck -s$_@x", min_size=1, max_size=3).filter(lambda t: t.strip() == t and t), st.booleans()),
        min_size=1,
        max_size=8,
    ),
    st.lists(st.text("abck -s$@4_z5é.", max_size=8), min_size=1, max_size=12),
)
def test_batch_kernel_property(words, texts):
    """List order, boundaries, gaps and substitutions against one regex per term."""
    terms = TermList.of([Term(i, w, "", whole) for i, (w, whole) in enumerate(words)])
    _, first = _kernel(*_compiled(terms))
    assert first(pa.array(texts, pa.string())).to_pylist() == [python_first(terms, t) for t in texts]


def test_long_lists_are_matched_in_chunks(spark):
    terms = TermList.of([Term(i, f"w{i:04d}q") for i in range(1000)])
    assert spark_first(spark, terms, ["x w0999q w0700q", "w0000q", "w1000q"]) == ["w0700q", "w0000q", None]


def test_null_text_is_clean(spark):
    df = spark.createDataFrame([(1, None), (2, "zebra")], "i int, text string")
    assert [r.i for r in filters.blocklist_filter(df, TERMS).collect()] == [1]
    assert spark_first(spark, TERMS, [None]) == [None]


def test_empty_list_and_single_mode_lists(spark):
    df = spark.createDataFrame([(1, "zebra hill")], "i int, text string")
    assert filters.blocklist_filter(df, TermList.of([])).count() == 1
    assert filters.blocklist_filter(df, TermList.of([Term(0, "hill", "", True)])).count() == 0
    assert filters.blocklist_filter(df, TermList.of([Term(0, "zeb")])).count() == 0
    assert filters.flagged(df, TermList.of([])).count() == 0


def test_duplicates_keep_the_first():
    terms = TermList.of([Term(3, "B"), Term(1, "b", "x", True), Term(2, "a"), Term(9, "")])
    assert [(t.ord, t.term, t.whole_word) for t in terms.terms] == [(1, "b", True), (2, "a", False)]


def test_wide_list_first_match_in_spark(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcdefghilmnorstu") for _ in range(5)) for _ in range(700)})
    rng.shuffle(words)
    terms = TermList.of([Term(i, w) for i, w in enumerate(words)])
    texts = [
        " ".join(rng.choice(words) if rng.random() < 0.05 else "qqqqq" for _ in range(20)) for _ in range(60)
    ]
    assert spark_first(spark, terms, texts) == [python_first(terms, t) for t in texts]


def test_list_of_any_length_is_read(spark):
    table = spark.range(3000).selectExpr("id AS ord", "'t' || id AS term", "'' AS category", "false AS whole_word")
    assert len(TermList.from_table(table).terms) == 3000


def test_whole_words_compile_only_when_needed(spark, monkeypatch):
    """Clean texts must not pay for the exact pattern of a long whole-word list."""
    terms = TermList.of([Term(i, f"word{i}x", whole_word=True) for i in range(2000)])
    df = spark.createDataFrame([(1, "clean text"), (2, "a word7x b"), (3, "éword7x")], "i int, text string")
    assert [r.i for r in filters.flagged(df, terms).collect()] == [2]


def test_term_table_keeps_first_ordinal(spark):
    rows = [(2, "Dog", "b", False), (1, "dog", "a", True), (3, "cat", "c", False), (4, "", "d", False)]
    df = spark.createDataFrame(rows, "ord int, term string, category string, whole_word boolean")
    got = {tuple(r) for r in audit.term_table(df).collect()}
    assert got == {(1, "dog", "a", True), (3, "cat", "c", False)}
    assert [t.term for t in TermList.from_table(audit.term_table(df)).terms] == ["dog", "cat"]


def test_phrases_have_no_substitutions(spark):
    df = spark.createDataFrame([(1, "MIT License"), (2, "m1t license"), (3, None)], "i int, text string")
    assert sorted(r.i for r in filters.phrase_filter(df, ["mit license"]).collect()) == [2, 3]
    assert filters.phrase_filter(df, []).count() == 3
    found = df.select("i", first_phrase(F.col("text"), ["license", "mit license", "a.b"]).alias("p")).collect()
    assert {r.i: r.p for r in found} == {1: "license", 2: "license", 3: None}
