"""Language ID and quality: accuracy on held-out rows, brute-force parses, edges."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from quillsieve.llm import langid, quality, queries


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=30), st.text("abc", max_size=12))
def test_automaton_knows_all_substrings(sample, probe):
    table = langid.SuffixAutomaton([ord(c) - 97 for c in sample], 3).table
    state = 1
    for c in probe:
        state = table[state, ord(c) - 97]
        if state == 0:
            break
    assert (state > 0) == (probe in sample)


def brute_phrases(parser, sample, text):
    """Greedy longest phrases of ``text`` that occur in ``sample``, segment by segment."""
    source = bytes(parser.symbols([sample])[0].tolist())
    symbols = bytes(parser.symbols([text])[0].tolist())
    total = 0
    for low in range(0, len(symbols), langid.SEGMENT):
        part = symbols[low : low + langid.SEGMENT]
        at = 0
        while at < len(part):
            end = at + 1
            while end < len(part) and part[at : end + 1] in source:
                end += 1
            total += 1
            at = end
    return total


def test_parse_equals_brute_force():
    samples = {"x": "the cat sat on the mat with a hat " * 5, "y": "der hund und die katze auf dem dach " * 5}
    parser = langid.Parser(samples)
    texts = ["the dog sat on der mat", "die katze", "Q!", "zzz the", "", "the cat sat " * 200]
    got = parser.phrases(*parser.symbols(texts))
    assert got.tolist() == [[brute_phrases(parser, samples[k], t) for k in ("x", "y")] for t in texts]


def test_language_table(spark, sf_dir):
    docs = {r.doc_id: r for r in queries.table(spark, sf_dir, "documents").collect()}
    got = queries.op3_language_id(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(docs) and all(r.held_out == held(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert np.mean(right) >= 0.97


def test_language_edges(spark):
    kind = "doc_id bigint, text string, lang string, score int"
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, " 12 !", None, 1), (None, "the house", "en", 1), (4, "la casa", "es", 1), (4, "la casa", "es", 1)]
    df = spark.createDataFrame(rows, kind)
    got = langid.identify(df, {"en": "the house and the tree", "es": "la casa y el arbol"}).collect()
    names = sorted((r.doc_id or 0, r.lang_pred) for r in got)
    assert names == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "es"), (4, "es")]
    assert langid.learn(df.limit(0)) == {}
    assert {r.lang_pred for r in langid.identify(df, {}).collect()} == {"und"}
    assert set(langid.learn(df)) <= {"en", "es"}


def test_only_other_folds_are_learned_from(spark):
    rows = [(i, "held" if held(i) else "open", "en") for i in range(60)]
    sample = langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))["en"]
    assert "open" in sample and "held" not in sample


def test_every_language_is_learned(spark):
    """Rows without id, rows with one id, and one text under many ids; late parts of long texts count as well."""
    english = [(None, f"the house number {n} stands near the old tree and the river " * 20, "en") for n in range(400)]
    spanish = [(7, f"la casa número {n} está cerca del árbol viejo y del río " * 20, "es") for n in range(400)]
    french = [(n, "une maison près du vieil arbre et de la rivière " * 30, "fr") for n in range(400)]
    late = [(n, "a" * 40_000 + " zzyzx" * 7_000, "xx") for n in range(40)]
    df = spark.createDataFrame(english + spanish + french + late, "doc_id bigint, text string, lang string").repartition(4)
    samples = langid.learn(df)
    assert set(samples) == {"en", "es", "fr", "xx"} and all(samples.values())
    assert "zzyzx" in samples["xx"]
    assert all(len(t) <= langid.SAMPLE_CHARS for t in samples.values())
    assert len({t for t in samples["en"].split("\n")}) > 20
    found = langid.identify(df.limit(400).union(df.where("lang = 'fr'").limit(3)).select("doc_id", "text"), samples)
    assert found.where("lang_pred = 'und'").count() == 0


def test_quality_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    got = queries.op8_quality(spark, sf_dir).collect()
    assert len(got) == queries.texts(spark, sf_dir).count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(r.doc_id) for r in got)
    known = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) >= 0.9


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (None, "text", 5.0), (3, "text", None), (3, "text", None)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    model = quality.learn(docs, labels)
    assert model == 1.0  # one class only
    assert [r.score for r in quality.score(docs, model).collect()] == [1.0] * 5
    assert quality.learn(docs.limit(0), labels.limit(0)) == 1.0
    real = quality.Model(b"good text " * 50, b"BAD!! " * 50, False, [0.0, 1.0, 0.0])
    scored = quality.score(docs, real)
    assert scored.columns == ["doc_id", "text", "score"]
    assert sorted(r.score for r in scored.where("coalesce(text, '') = ''").collect()) == [0.0, 0.0]


def test_few_samples_still_make_a_model(spark):
    rows = [(i, f"calm words number {i}" if i % 2 else f"SHOUT!! {i}!!", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    model = quality.learn(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    scores = {r.doc_id: r.score for r in quality.score(df.select("doc_id", "text"), model).collect()}
    assert np.mean([scores[i] for i in range(1, 40, 2)]) > np.mean([scores[i] for i in range(0, 40, 2)])
