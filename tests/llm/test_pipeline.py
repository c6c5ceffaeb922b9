"""The pipeline's stages against brute-force versions, each on the rows of the stage before."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quillsieve.llm import quality, queries
from quillsieve.llm.packing import CAPACITY
from quillsieve.llm.tokens import PieceTokenizer, vocabulary
from quillsieve.runtime import materialize
from tests.llm import test_decontam, test_minhash, test_substring

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents")
    out = [("documents", rows)]
    for name, stage in pipeline.STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name)
        out.append((name, rows))
    return dict(out)


def held(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "decontamination", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == COLUMNS


def test_quality(spark, sf_dir, stages):
    docs, labels = stages["documents"], queries.table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels)
    compressors = model.compressors()
    rows = held(docs)
    scores = model.score(quality.features(list(rows.values()), compressors))
    want = {d for (d, t), s in zip(rows.items(), scores) if t and s >= 0.3}
    assert set(held(stages["quality"])) == want and want != set(rows)


def test_near_duplicates(stages):
    want = test_minhash.brute(list(held(stages["quality"]).items()))
    assert set(held(stages["near_duplicates"])) == {d for d, (_, _, kept) in want.items() if kept}


def test_repeats(stages):
    rows = held(stages["near_duplicates"])
    want = {d: t if g == 0 else kept for (d, t), (_, g, kept) in zip(rows.items(), test_substring.brute(list(rows.items()), 50).values())}
    assert held(stages["repeats"]) == want


def test_decontamination(spark, sf_dir, stages):
    rows = held(stages["repeats"])
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    small = {d: t for d, t in rows.items() if len(t) < 3000}
    bad = {d for d, _ in test_decontam.brute(list(small.items()), items)}
    kept = set(held(stages["decontamination"]))
    assert bad and set(small) & kept == set(small) - bad


def test_packing(stages):
    check_pieces(held(stages["decontamination"]), stages["packing"].toPandas())


def check_pieces(texts, got):
    """Every id of every document lies in one piece, and pieces fill windows from their start without gaps."""
    library = PieceTokenizer(vocabulary("byte_bpe_50k.json"))
    ids = {d: [*x, 1] for d, x in zip(texts, library.raw([t or "" for t in texts.values()]))}
    assert {d: int(n) for d, n in got.groupby("doc_id")["length"].sum().items()} == {d: len(x) for d, x in ids.items()}
    for doc, own in got.groupby("doc_id"):
        at = 0
        for p in own.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids[doc])
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[doc][p.start : at], "<u4").tobytes())
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
        assert own["length"].sum() <= CAPACITY


def test_rows_without_ids_or_text(spark, sf_dir):
    rows = [(None, "some words here", "en", "a", 1), (7, None, None, None, None), (7, "", "en", "b", 0), (8, "x" * 10, "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in pipeline.STAGES[1:]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    assert {r.doc_id for r in docs.collect()} == {None, 7, 8}
    empty = queries.table(spark, sf_dir, "documents").limit(0)
    for name, stage in pipeline.STAGES:
        empty = materialize(stage(spark, empty, sf_dir), name)
    assert empty.collect() == []


def test_stages_decide_by_row(spark, sf_dir):
    item = queries.table(spark, sf_dir, "benchmark").where("text is not null").first().text
    clean = " ".join(f"clean{n}" for n in range(40))
    rows = [(None, f"before {item} after"), (None, clean), (5, item), (5, clean + " more"), (6, "short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {(r.doc_id, r.text) for r in pipeline.drop_contaminated(spark, docs, sf_dir).collect()}
    assert left == {rows[1], rows[3], rows[4]}
    left = sorted(((r.doc_id or 0, r.text) for r in pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()))
    assert (5, clean + " more") in left and (0, clean) not in left and (6, "short") in left
    copies = spark.createDataFrame([(None, clean)] * 3 + [(None, None)] * 2, "doc_id bigint, text string")
    assert sorted(str(r.text) for r in pipeline.drop_near_duplicates(spark, copies, sf_dir).collect()) == ["None", "None", clean]


def test_clashing_columns_come_through(spark, sf_dir):
    """Extra columns with names the stages use themselves keep their values."""
    names = ["group", "score", "row_key", "mark", "n_words", "n_removed", "kept_text", "component_id", "node", "label"]
    docs = queries.table(spark, sf_dir, "documents").select("*", *(F.lit(n).alias(c) for n, c in enumerate(names)))
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == COLUMNS + names
    assert [tuple(r) for r in docs.select(*names).distinct().collect()] == [tuple(range(len(names)))]
    assert pipeline.pack_windows(spark, docs, sf_dir).count() > 0
