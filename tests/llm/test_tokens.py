"""Tokenising, packing, id files and separator scan: exact round trips against the tokenizers library."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quillsieve.llm import idfiles, packing, queries, tokencounts
from quillsieve.llm.tokens import PieceTokenizer, vocabulary
from quillsieve.runtime import run_dir
from tests.llm.test_pipeline import check_pieces

KIND = "doc_id bigint, text string, start string, length int"
ROWS = [(5, "b  c\n\nd", "x", 1), (2, None, "x", 1), (9, "", None, 1), (2, "again", "x", None), (7, "word " * 3000, "x", 1), (1, '"!" <|endoftext|>', "x", 1)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module", params=["byte_bpe_50k.json", "word_bpe_49k.json"])
def library(request):
    return PieceTokenizer(vocabulary(request.param))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab Z1.,!'s\n\t\r éßĀ́ 　\x02\x1c<|>"), max_size=25), max_size=5))
def test_pieces_equal_the_library(library, texts):
    ids, counts = library.encode(pa.array(texts, pa.string()))
    want = library.raw(texts)
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_cache_starts_afresh(library, monkeypatch):
    monkeypatch.setattr("quillsieve.llm.tokens.CACHE_PIECES", 3)
    for text in ("one two three four five", "two three, four.", "one two"):
        assert library.encode(pa.array([text]))[0].tolist() == library.raw([text])[0]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 600), min_size=1, max_size=60))
def test_groups_fit_their_windows(sizes):
    sizes = np.array(sizes)
    window = packing.pack_group(sizes, 600)
    loads = np.bincount(window, sizes)
    assert loads.max() <= 600 and len(window) == len(sizes)


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(2).integers(1, 256, 900)
    loads = np.bincount(packing.difference(sizes, 50), sizes, 50)
    assert loads.max() - loads.min() <= 3


def test_packing_table(spark, sf_dir):
    rows = {r.doc_id: r.text for r in queries.texts(spark, sf_dir).collect()}
    got = queries.op1_packing(spark, sf_dir).toPandas()
    check_pieces(rows, got)
    loads = got.groupby("sequence_id")["length"].sum()
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in loads)
    assert padding <= 0.02 * loads.sum() + 2048


def test_packing_edges(spark):
    path = vocabulary("byte_bpe_50k.json")
    df = spark.createDataFrame(ROWS, KIND).repartition(3)
    got = packing.pack(df, path).toPandas()
    assert got["length"].sum() == sum(len(x) + 1 for x in PieceTokenizer(path).raw([r[1] or "" for r in ROWS]))
    assert packing.pack(df.limit(0), path).collect() == []
    whole = packing.sequences(packing.pack(df, path)).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 4 * 2048 for r in whole)
    with pytest.raises(ValueError):
        packing.cut_documents(df, path, item_tokens=4096)


def test_repeated_null_ids_are_spread(spark):
    """A third of the rows without doc_id: groups go by row, not by id."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(100).cast("bigint").alias("length")
    )
    path = run_dir(spark, "items")
    df.write.parquet(path)
    got = packing.pack_pieces(spark.read.parquet(path), group_windows=8)
    groups = {r.sequence_id >> 33 for r in got.collect()}
    assert got.count() == 3000 and len(groups) >= 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 3), st.just(2**32 - 1)), max_size=9000))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    blocks = idfiles.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert (idfiles.decode_blocks(b"".join(blocks), starts)[: len(ids)] == ids).all()


def test_outliers_are_exceptions():
    ids = np.full(4096, 7, np.uint32)
    ids[::100] = 50_000
    (block,) = idfiles.encode_blocks(ids)
    assert len(block) < 400


def test_id_files_table(spark, sf_dir):
    rows = dict(sorted((r.doc_id, r.text) for r in queries.texts(spark, sf_dir).collect()))
    want, at = [], 0
    for d, x in zip(rows, PieceTokenizer(vocabulary("word_bpe_49k.json")).raw(list(rows.values()))):
        want.append((d, at, len(x) + 1, crc([*x, 1])))
        at += len(x) + 1
    assert sorted(tuple(r) for r in queries.op9_id_files(spark, sf_dir).collect()) == want


def test_id_files_edges(spark):
    path = vocabulary("word_bpe_49k.json")
    df = spark.createDataFrame(ROWS, KIND).repartition(3)
    got = sorted(idfiles.roundtrip(df, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1, 2, 2, 5, 7, 9]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert got[1].ids == np.array([1], "<u4").tobytes()
    assert idfiles.roundtrip(df.limit(0), path).collect() == []


def test_id_files_keep_every_doc_id(spark):
    """Missing ids come back missing and come first; ids beyond 2**53 keep all digits."""
    path = vocabulary("word_bpe_49k.json")
    big = [2**53 + 1, -(2**63), 2**63 - 1, 0]
    rows = [(d, f"text {n}") for n, d in enumerate(big)] + [(None, "no id"), (None, None), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(idfiles.roundtrip(df, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 3 + sorted(big)
    ids = PieceTokenizer(path).raw([t or "" for _, t in rows])
    want = sorted(((d is not None, d or 0), crc([*x, 1])) for (d, _), x in zip(rows, ids))
    assert sorted(((r.doc_id is not None, r.doc_id or 0), zlib.crc32(bytes(r.ids))) for r in got) == want


@pytest.mark.parametrize("block,run", [(1, 2), (3, 2), (7, 4096), (1000, 4096)])
def test_separator_scan(spark, block, run):
    r = np.random.default_rng(block)
    folder = run_dir(spark, "flat")
    rows, want = [], set()
    fs, root = idfiles.filesystem(folder if "://" in folder else f"file://{folder}")
    fs.create_dir(root, recursive=True)
    files = [[], [9], [5], [9, 9, 5], [5] * 40, *[r.integers(5, 10, 50).tolist() for _ in range(3)]]
    for n, ids in enumerate(files):
        name = f"{folder}/{n}.bin"
        with fs.open_output_stream(f"{root}/{n}.bin") as out:
            out.write(np.array(ids, "<u2").tobytes())
        rows.append((name, len(ids)))
        start = k = 0
        for at, token in enumerate(ids):
            if token == 9 or at == len(ids) - 1:
                want.add((name, k, start, at + 1 - start, token == 9))
                start, k = at + 1, k + 1
    df = spark.createDataFrame(rows, "file string, n_ids bigint")
    got = tokencounts.count_tokens(df, separator=9, block_ids=block, run_blocks=run)
    assert {tuple(x) for x in got.collect()} == want


def test_token_counts_table(spark, sf_dir):
    rows = {r.doc_id: r.text for r in queries.texts(spark, sf_dir).collect()}
    want = {d: len(x) + 1 for d, x in zip(rows, PieceTokenizer(vocabulary("byte_bpe_50k.json")).raw(list(rows.values())))}
    got = queries.op6_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(want) and all(r.terminated for r in got)


def test_token_counts_broadcast_nothing(spark):
    """One block and one portion name many documents, so small tables say nothing about the sizes joined."""
    path = vocabulary("byte_bpe_50k.json")
    rows = [r[:2] for r in ROWS] + [(None, "no id"), (None, None), *[(n, "x" * (n % 7)) for n in range(300)]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    written = tokencounts.write_flat(df, path, run_dir(spark, "flat"), separator=50256)
    files = written.groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    counts = tokencounts.count_tokens(files, separator=50256, block_ids=500, run_blocks=2)
    named = tokencounts.with_doc_ids(counts, written)
    assert named.columns == ["file", "ordinal", "start", "n_tokens", "terminated", "doc_id"]
    want = [(d, len(x) + 1, True) for (d, _), x in zip(rows, PieceTokenizer(path).raw([t or "" for _, t in rows]))]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_tokens, r.terminated) for r in named.collect()), key=order) == sorted(want, key=order)
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_flat_files_refuse_what_they_cannot_hold(spark):
    path = vocabulary("byte_bpe_50k.json")
    df = spark.createDataFrame(ROWS, KIND)
    assert tokencounts.write_flat(df.limit(0), path, run_dir(spark, "flat"), separator=50256).collect() == []
    with pytest.raises(ValueError):
        tokencounts.write_flat(df, path, run_dir(spark, "flat"), separator=70_000)
    with pytest.raises(Exception, match="occurs in a text"):
        tokencounts.write_flat(df, path, run_dir(spark, "flat"), separator=1)
