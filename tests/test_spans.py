"""Places of terms against each term's own pattern."""

import random
import re

from quillsieve.functions.patterns import Term, TermList, exact_pattern
from quillsieve.operators import spans


def brute(rows, terms, context=30):
    out = []
    for k, text in rows:
        for t in terms.terms:
            for m in re.finditer(exact_pattern(t), (text or "").lower()):
                a, b = m.span()
                out.append((k, t.ord, t.term, a, b, text[a:b], text[max(0, a - context) : b + context]))
    return sorted(out, key=repr)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_random_texts(spark):
    r = random.Random(3)
    letters = "aAbeilos@4^3&1!|y0*$5z7+v -_.éÀ"
    rows = [(n, "".join(r.choice(letters) for _ in range(r.randint(0, 120)))) for n in range(120)] + [(None, "aaa a4a"), (900, None), (901, "")]
    terms = {"".join(r.choice("abeilos v-é") for _ in range(r.randint(1, 4))).strip() for _ in range(40)} - {""}
    terms |= {"aa", "a a", " ab", "-"}
    listed = TermList.of([Term(n, t, "c", n % 4 == 0 and t == t.strip()) for n, t in enumerate(sorted(terms))])
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows, listed)
    assert len(want) > 300
    assert answer(spans.term_spans(df, listed)) == want


def test_context_and_no_terms(spark):
    df = spark.createDataFrame([(1, "One B4DWORD here"), (2, "clean")], "doc_id bigint, text string")
    listed = TermList.of([Term(5, "badword")])
    assert answer(spans.term_spans(df, listed, context=4)) == [(1, 5, "badword", 4, 11, "B4DWORD", "One B4DWORD her")]
    assert spans.term_spans(df, TermList()).collect() == []


def test_one_worker_reads_small_slices(spark, monkeypatch):
    listed = TermList.of([Term(1, "badword"), Term(2, "a b")])
    df = spark.createDataFrame([(n, f"É x B4D­word {'y' * n} a b") for n in range(300)] + [(None, None)], "doc_id bigint, text string")
    found = spans.term_spans(df, listed)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and plan.count("MapInArrow") == 1
    assert answer(found) == brute(df.collect(), listed)


def test_places_of_folded_letters():
    for text in ("", "é a b-c", "x  y", "日本 b4d", "- _."):
        short, at = spans._starts(text)
        each = [(spans.fold(c), n) for n, c in enumerate(text)]
        assert short.encode("latin-1") == b"".join(f for f, _ in each)
        assert at.tolist() == [n for f, n in each for _ in f]
