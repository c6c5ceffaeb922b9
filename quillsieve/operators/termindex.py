"""Matching against term tables of any size, by an index on rare grams.

Texts and terms are folded: lower-cased, every character that some term letter
accepts as a stand-in mapped to one sign for its class, and everything that a
space of a term may stand for removed. A term can occur in a text only if the
folded term occurs in the folded text, and thus every run of ``GRAM`` bytes
(gram) of it. Each term is filed under its rarest gram; a text's grams, as far as
a fixed-size bit table says that terms may be filed there, meet the index in a
Spark join. The pairs that result are verified on the text with the term's
exact pattern, as the plain operators do with their lists.

Nothing grows on the driver: it holds a table of gram counts' buckets and the bit
table, whatever the number of terms and texts. A gram of many texts is salted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.patterns import GAP_CHARS, SUBSTITUTIONS, Term, exact_pattern
from ..runtime import materialize
from .audit import term_table

# Bytes of a gram; shorter terms are filed whole.
GRAM = 5
# Buckets that gram counts are kept in, and bits of the table of filed grams (powers of two).
COUNT_BITS = 18
TABLE_BITS = 24
# Occurrences of a gram that one salted key takes.
SALT_ROWS = 65_536
SLICE_BYTES = 2 << 20


def _classes() -> dict[str, str]:
    """Each stand-in character's sign: letters whose stand-ins overlap share one."""
    sign = {}
    for letter, others in SUBSTITUTIONS.items():
        joined = {sign.get(c, c) for c in (letter, *others)}
        least = min(joined)
        for c in (letter, *others, *(k for k, v in sign.items() if v in joined)):
            sign[c] = least
    return sign


_SIGNS = _classes()
_TABLE = bytes(ord(_SIGNS.get(chr(b), chr(b))) if b < 128 else b for b in range(256))
_DROPPED = bytes(ord(c) for c in GAP_CHARS if ord(c) < 128)
_WIDE_GAPS = [c.encode() for c in GAP_CHARS if ord(c) >= 128]


def fold(lowered: str) -> bytes:
    """The folded form of a lower-cased text."""
    data = lowered.encode("utf-8", "surrogatepass")
    if not lowered.isascii():
        for gap in _WIDE_GAPS:
            data = data.replace(gap, b"")
    return data.translate(_TABLE, _DROPPED)


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The number of every run of ``size`` bytes, told apart by size."""
    out = np.zeros(max(0, len(data) - size + 1), np.uint64)
    for k in range(size):
        out |= data[k : k + len(out)].astype(np.uint64) << np.uint64(8 * k)
    return out | np.uint64(size << 56)


def spread(keys: np.ndarray, bits: int) -> np.ndarray:
    """A hash of ``bits`` bits for each gram."""
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _folded_terms(terms: DataFrame) -> DataFrame:
    """ord, term, category, whole_word and the grams a term may be filed under (0 if nothing is left of it)."""
    schema = pa.schema([
        ("ord", pa.int64()), ("term", pa.string()), ("category", pa.string()), ("whole_word", pa.bool_()),
        ("grams", pa.list_(pa.int64())), ("buckets", pa.list_(pa.int64())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for term in batch.column("term").to_pylist():
                data = np.frombuffer(fold(term), np.uint8)
                found.append(np.unique(grams(data, min(GRAM, len(data)))) if len(data) else np.zeros(1, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g.view(np.int64) for g in found], pa.list_(pa.int64())),
                 pa.array([spread(g, COUNT_BITS) for g in found], pa.list_(pa.int64()))], schema=schema,
            )

    plain = terms.select(F.col("ord").cast("bigint"), "term", "category", F.coalesce("whole_word", F.lit(False)).alias("whole_word"))
    kind = "ord bigint, term string, category string, whole_word boolean, grams array<bigint>, buckets array<bigint>"
    return plain.mapInArrow(read, kind)


def text_slices(batches: Iterator[pa.RecordBatch], text: str | int = "text") -> Iterator[pa.RecordBatch]:
    """Batches of a few megabytes of text; a longer text is one of its own."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded texts one after the other, each followed by a zero byte, and where each begins (and the end)."""
    import pyarrow.compute as pc

    pieces = [fold(t or "") + b"\0" for t in pc.utf8_lower(texts).to_pylist()]
    starts = np.cumsum([0, *map(len, pieces)])
    return np.frombuffer(b"".join(pieces), np.uint8), starts


def gram_counts(texts: DataFrame) -> DataFrame:
    """bucket, occurrences: how often grams of the index's size occur, in 2**COUNT_BITS buckets, over all texts."""
    schema = pa.schema([("bucket", pa.int64()), ("seen", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for part in text_slices(batches):
            data, _ = _folded(part.column("text"))
            total += np.bincount(spread(grams(data, GRAM), COUNT_BITS), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], schema=schema)

    return texts.select("text").mapInArrow(count, "bucket bigint, seen bigint").groupBy("bucket").agg(F.sum("seen").alias("seen"))


def _filed(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """Every term with its rarest ``gram`` and how often that may occur (``seen``; unknown for short ones)."""
    each = _folded_terms(terms).select("ord", "term", "category", "whole_word", F.explode(F.arrays_zip("grams", "buckets")).alias("g"))
    each = each.select("ord", "term", "category", "whole_word", F.col("g.grams").alias("gram"), F.col("g.buckets").alias("bucket"))
    counted = each.join(materialize(gram_counts(texts), "gram-counts"), "bucket", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    # Ties go to the smaller gram.
    best = counted.groupBy("ord", "term", "category", "whole_word").agg(F.min(F.struct("seen", "gram")).alias("best"))
    return materialize(best.select("ord", "term", "category", "whole_word", "best.gram", "best.seen"), "filed")


def _bit_table(filed: DataFrame) -> np.ndarray:
    """Flags of the grams that terms are filed under, 2**TABLE_BITS of them at any number of terms."""
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(spread(batch.column("gram").to_numpy().view(np.uint64), TABLE_BITS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], schema=schema
            )

    words = filed.select("gram").mapInArrow(place, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    packed = np.zeros((1 << TABLE_BITS) // 64, np.uint64)
    found = words.toArrow()
    packed[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return packed


def _met(rows: DataFrame, keys: list[str], table: np.ndarray, sizes: list[int]) -> DataFrame:
    """The key columns and each distinct gram of a text under which terms may be filed."""
    kind = rows.select(*keys).schema.add("gram", "long")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            data, starts = _folded(part.column("text"))
            row_of = np.repeat(np.arange(part.num_rows), np.diff(starts))
            found = []
            for size in sizes:
                if size == 0:  # terms of which nothing is left meet every text
                    found.append((np.arange(part.num_rows), np.zeros(part.num_rows, np.uint64)))
                    continue
                own = grams(data, size)
                bit = spread(own, TABLE_BITS)
                at = np.flatnonzero((table[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1))
                found.append((row_of[at], own[at]))
            row, gram = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((gram, row))
            row, gram = row[order], gram[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
            taken = part.select(keys).take(pa.array(row[fresh]))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(gram[fresh].view(np.int64))], [*keys, "gram"])

    return rows.select(*keys, "text").mapInArrow(probe, kind)


def term_hits(
    docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", first_only: bool = False
) -> DataFrame:
    """``key``, ord, term, category of every term that occurs in a row's text; of the first in list order only, if so asked.

    ``terms`` has ord, term, category, whole_word, and may have any number of
    rows; of terms that differ in case only the first counts, and empty ones
    don't. Rows with one key are matched by their own texts, and equal hits are
    returned once. A null text has no hits. The texts are read twice and, if they
    have candidates, shuffled once.
    """
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("content"), F.col(text).alias("text"))
    filed = _filed(term_table(terms), rows)
    sizes = sorted(r.size for r in filed.select(F.shiftright("gram", 56).alias("size")).distinct().collect())
    none = docs.sparkSession.createDataFrame([], docs.select(key).schema.add("ord", "long").add("term", "string").add("category", "string"))
    if not sizes:
        return none
    met = materialize(_met(rows, ["key", "content"], _bit_table(filed), sizes), "met")
    # Short terms' grams are not counted beforehand: salts come from what was met.
    seen = met.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    index = filed.join(seen, "gram").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    index = materialize(index.select("gram", "salt", "salts", "ord", "term", "category", "whole_word"), "index")
    # One row for each gram: what the texts' side needs to pick a salt.
    split = materialize(seen.where("salts > 1"), "hot-grams")
    salted = met.join(F.broadcast(split) if split.count() < 100_000 else split, "gram", "left")
    salted = salted.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("key", "content"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    found = salted.join(index.drop("salts"), ["gram", "salt"])
    listed = found.groupBy("key", "content").agg(F.sort_array(F.collect_list(F.struct("ord", "term", "category", "whole_word"))).alias("candidates"))
    kind = docs.select(F.col(key).alias("key")).schema.add("ord", "long").add("term", "string").add("category", "string")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        patterns: dict[tuple[str, bool], re.Pattern] = {}
        folded_terms: dict[str, bytes] = {}
        for part in text_slices(batches):
            at, out = [], []
            lowered = pc.utf8_lower(part.column("text")).to_pylist()
            for n, (whole, candidates) in enumerate(zip(lowered, part.column("candidates").to_pylist())):
                short = fold(whole)
                for c in candidates:
                    name = (c["term"], c["whole_word"])
                    if name not in patterns:
                        if len(patterns) > 50_000:
                            patterns.clear()
                            folded_terms.clear()
                        patterns[name] = re.compile(exact_pattern(Term(0, c["term"], "", c["whole_word"])))
                        folded_terms[c["term"]] = fold(c["term"])
                    if folded_terms[c["term"]] in short and patterns[name].search(whole):
                        at.append(n)
                        out.append(c)
                        if first_only:
                            break
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(at, pa.int64())), *(pa.array([c[f] for c in out], t) for f, t in (("ord", pa.int64()), ("term", pa.string()), ("category", pa.string())))],
                ["key", "ord", "term", "category"],
            )

    same = listed["key"].eqNullSafe(rows["key"]) & (listed["content"] == rows["content"])
    whole = listed.join(rows, same).select(rows["key"], rows["text"], "candidates")
    hits = whole.mapInArrow(verify, kind).distinct()
    return hits.withColumnRenamed("key", key)


def blocklist_filter(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no term of the table occurs; keys must be unique and not null."""
    return docs.join(term_hits(docs, terms, key, text, first_only=True).select(key), key, "left_anti")


def with_first_term(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", out: str = "matched_term") -> DataFrame:
    """``docs`` with the first term of the list that occurs, null for clean rows; keys must be unique."""
    hits = term_hits(docs, terms, key, text, first_only=True).select(key, F.col("term").alias(out))
    return docs.join(hits, key, "left")
