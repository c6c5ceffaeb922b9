"""The term index against the exact patterns of all terms."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.functions.patterns import Term, TermList, exact_pattern
from quillsieve.operators import filters, termindex
from quillsieve.plans.audit import audit_corpus

KIND = "ord int, term string, category string, whole_word boolean"


def brute(rows, terms):
    listed = TermList.of(Term(o, t, c or "", bool(w)) for o, t, c, w in terms if t).terms
    patterns = [(t, re.compile(exact_pattern(t))) for t in listed]
    return sorted({(k, t.ord, t.term) for k, x in rows if x is not None for t, p in patterns if p.search(x.lower())}, key=repr)


def found(df):
    return sorted({tuple(r) for r in df.collect()}, key=repr)


def random_text(r, letters, low, high):
    return "".join(r.choice(letters) for _ in range(r.randint(low, high)))


def test_random_terms(spark):
    r = random.Random(8)
    letters = "abeilostuck@4^3&1!|y0*$5z7+v -_.é X"
    rows = [(n, random_text(r, letters, 0, 60)) for n in range(150)] + [(500, None), (501, "")]
    terms = [(n, random_text(r, "abeilostuck -é.zv", 1, r.choice([1, 2, 3, 5, 9])).strip() or "a", "c", n % 3 == 0) for n in range(120)]
    terms += [(n + 200, t.upper(), "later", False) for n, (_, t, _, _) in enumerate(terms[:10])]
    # Terms cut out of texts, so that long ones occur.
    for n, (_, text) in enumerate(rows[:100]):
        cut = text[5:20].lower().strip()
        if cut:
            terms.append((1000 + n, cut, None, False))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    table = spark.createDataFrame(terms, KIND)
    want = brute(rows, terms)
    assert len(want) > 500
    assert found(termindex.term_hits(df, table).select("doc_id", "ord", "term")) == want
    first = {}
    for k, o, t in sorted(want, key=lambda x: x[1]):
        first.setdefault(k, t)
    got = {r.doc_id: r.matched_term for r in termindex.with_first_term(df, table).collect()}
    assert {k: v for k, v in got.items() if v} == first and len(got) == len(rows)
    plain = filters.blocklist_filter(df, TermList.from_table(table)).select("doc_id")
    assert found(termindex.blocklist_filter(df, table).select("doc_id")) == found(plain)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "Self - harm"), (1, "other"), (None, "selfharm"), (2, "ｓelf"), (2, "other")], "doc_id bigint, text string")
    terms = spark.createDataFrame([(0, "self harm", "x", True), (1, "", "x", False), (2, None, "x", False)], KIND)
    assert found(termindex.term_hits(docs, terms)) == [(1, 0, "self harm", "x"), (None, 0, "self harm", "x")]
    assert termindex.term_hits(docs, terms.limit(0)).collect() == []
    assert termindex.term_hits(docs.limit(0), terms).collect() == []
    blank = spark.createDataFrame([(0, " ", "x", False)], KIND)
    assert {r.doc_id for r in termindex.term_hits(docs, blank).collect()} == {1, 2, None}


@pytest.mark.parametrize("salt_rows", [4, 65_536])
def test_hot_grams_and_long_texts(spark, monkeypatch, salt_rows):
    monkeypatch.setattr(termindex, "SALT_ROWS", salt_rows)
    rows = [(n, "the same passage everywhere") for n in range(60)] + [(99, "filler " * 400_000 + "passaqe")]
    terms = [(0, "passage", "x", False), (1, "passaqe", "x", True), (2, "nowhere", "x", False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = found(termindex.term_hits(df, spark.createDataFrame(terms, KIND)).select("doc_id", "term"))
    assert got == sorted([(n, "passage") for n in range(60)] + [(99, "passaqe")], key=repr)


def test_audit_with_a_table(spark):
    """The audit gives the same rows whether the terms come as a list or as a table."""
    rows = [(n, n % 3, t) for n, t in enumerate(["b4dword here", "clean", "torture", "BADWORD and torture", None, "worse b a d", ""] * 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, shard bigint, text string")
    terms = spark.createDataFrame([(0, "badword", "x", False), (1, "worse", "y", True)], KIND)
    one, two = (audit_corpus(docs, t, ["torture"], group_rows=4) for t in (TermList.from_table(terms), terms))
    for name in ("kept", "counts", "log"):
        assert found(getattr(one, name)) == found(getattr(two, name).select(*getattr(one, name).columns))
    assert one.log.where("stage = 'phrase'").count() == 6


def test_many_terms(spark):
    """More terms than a pattern could hold; nothing about them passes the driver."""
    terms = spark.range(200_000).select(
        F.col("id").alias("ord"), F.concat(F.lit("t"), F.substring(F.md5(F.col("id").cast("string")), 1, 12)).alias("term"),
        F.lit("x").alias("category"), (F.col("id") % 2 == 0).alias("whole_word"),
    )
    some = {r.ord: r.term for r in terms.where("ord % 40000 < 2").collect()}
    rows = [(o, f"about {t} here") for o, t in some.items()] + [(o + 500_000, f"about x{t}x here") for o, t in some.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found(termindex.term_hits(df, terms).select("doc_id", "ord"))
    assert got == sorted([(o, o) for o in some] + [(o + 500_000, o) for o in some if o % 2], key=repr)


def test_folding_keeps_every_match():
    for letter, others in termindex.SUBSTITUTIONS.items():
        assert {termindex.fold(c) for c in others} == {termindex.fold(letter)}
    assert termindex.fold("a-b_c  é ") == termindex.fold("ab") + termindex.fold("c") + "é".encode()
    assert set(np.unique(termindex.grams(np.frombuffer(b"abcabc", np.uint8), 3))) and len(np.unique(termindex.grams(np.frombuffer(b"abcabc", np.uint8), 3))) == 3
