"""Benchmark decontamination by spaced-seed hashing.

A seed looks at six of several consecutive words and ignores the others, so a
word that was exchanged there doesn't hide a copy. Seeds of the benchmark items
meet the seeds at every place of every document; each hit names a diagonal
(document place minus item place), on which words are compared one by one.

The two masks hit every alignment of ``OVERLAP`` words with up to two exchanged
(proved by trying all of them, in the tests). For other lengths and shares, and
for items shorter than an overlap, the words are cut into one block more than may
be exchanged: one block is whole, and a seed looks at its beginning. So the result
is that of comparing all diagonals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillsieve.llm import arrow
from quillsieve.llm.words import mix, powers, read_words

# Places a seed looks at.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 5, 8, 9))
# A document is contaminated by an item if so many consecutive words, aligned without
# gaps, agree in this share of places. Items with fewer words must agree as a whole, in
# that share of their words.
OVERLAP = 13
SHARE = 0.8
# Items with fewer words than this must agree in all of them.
TOLERANT = 7
# Items with fewer words than this occur everywhere by chance: a document must be the item.
SHORTEST = 3
# Item text that is compared in one pass over the documents.
BLOCK_BYTES = 16 << 20
_STEP = 0xD1342543DE82EF95


def agreeing(words: int, share: float = SHARE) -> int:
    """Words of an overlap of ``words`` that must agree."""
    return words if words < TOLERANT else int(np.ceil(share * words - 1e-9))


def masks_for(least: int, share: float) -> tuple[tuple[int, ...], ...]:
    """Masks that hit every overlap of ``least`` words; refused if none of three words or more does."""
    wrong = least - agreeing(least, share)
    if least == OVERLAP and wrong <= 2:
        return MASKS
    block = least // (wrong + 1)
    if block < SHORTEST:
        raise ValueError(f"no seed finds overlaps of {least} words of which a share of {share} agrees")
    return (tuple(range(min(block, 6))),)


def seeds(hashes: np.ndarray, sizes: np.ndarray, mask: tuple[int, ...], which: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a mask, told apart by ``which``, at every place where it fits into its text, and those places."""
    span = mask[-1] + 1
    count = len(hashes) - span + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    steps = powers(_STEP, len(mask) + 1)
    total = np.full(count, which + 1, np.uint64)
    for place, step in zip(mask, steps[1:]):
        total += hashes[place : place + count] * step
    ends = np.repeat(np.cumsum(sizes), sizes)
    places = np.flatnonzero(np.arange(count) + span <= ends[:count])
    return mix(total[places]), places


class Items:
    """Some benchmark items, and which of them hold a seed."""

    def __init__(self, ids: list[int], texts: pa.Array, least: int = OVERLAP, share: float = SHARE):
        words = read_words(texts)
        self.least, self.share = least, share
        self.ids, self.sizes, self.first = ids, words.sizes, words.first
        self.words = words.hashes(fold=True)
        owner = np.repeat(np.arange(len(ids)), words.sizes)
        self.masks = (*masks_for(least, share), tuple(range(SHORTEST)))
        # Of an item shorter than an overlap only the beginnings of its blocks are seeds.
        wrong = np.array([m - agreeing(m, share) for m in range(max(least, 1))])
        short = words.sizes < least
        block = np.where(short, words.sizes // (wrong[np.where(short, words.sizes, 0)] + 1), 1)
        if (short & (words.sizes >= SHORTEST) & (block < SHORTEST)).any():
            raise ValueError(f"no seed finds short items of which a share of {share} agrees")
        self.tables = []
        for which, mask in enumerate(self.masks):
            keys, places = seeds(self.words, words.sizes, mask, which)
            item = owner[places]
            at = places - self.first[item]
            used = ~short[item] if which < len(self.masks) - 1 else short[item] & (at % np.maximum(block[item], 1) == 0)
            keys, places = keys[used], places[used]
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], places[order]))
        self.owner = owner
        # Items of a word or two, by their hashes.
        self.tiny: dict[tuple[int, ...], list[int]] = {}
        for item in np.flatnonzero((words.sizes > 0) & (words.sizes < SHORTEST)).tolist():
            own = self.words[self.first[item] : self.first[item] + words.sizes[item]]
            self.tiny.setdefault(tuple(own.tolist()), []).append(item)
        total = sum(len(keys) for keys, _ in self.tables)
        # One byte for each of 64 slots a seed: few documents' seeds pass by chance.
        self.slots = np.uint64(max(1 << 16, 1 << (64 * total).bit_length()) - 1)
        self.taken = np.zeros(int(self.slots) + 1, bool)
        for keys, _ in self.tables:
            self.taken[keys & self.slots] = True

    def diagonals(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, diagonal) that share a seed."""
        first = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        found = [np.zeros((0, 3), np.int64)]
        for which, (keys, at) in enumerate(self.tables):
            if not len(keys):
                continue
            own, places = seeds(hashes, sizes, self.masks[which], which)
            maybe = np.flatnonzero(self.taken[own & self.slots])
            own, places = own[maybe], places[maybe]
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            times = high - low
            hit = at[np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
            place = np.repeat(places, times)
            item = self.owner[hit]
            found.append(
                np.column_stack([text[place], item, place - first[text[place]] - (hit - self.first[item])])
            )
        for n in np.flatnonzero((sizes > 0) & (sizes < SHORTEST)).tolist() if self.tiny else ():
            same = self.tiny.get(tuple(hashes[first[n] : first[n] + sizes[n]].tolist()), [])
            found.append(np.array([(n, item, 0) for item in same], np.int64).reshape(-1, 3))
        return np.unique(np.concatenate(found), axis=0)

    def overlap(self, hashes: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int, int] | None:
        """(document place, item place, words, agreeing words) of the overlap on a diagonal, if there is one."""
        size = int(self.sizes[item])
        own = self.words[self.first[item] : self.first[item] + size]
        low, high = max(0, -diagonal), min(size, len(hashes) - diagonal)
        width = min(self.least, size)
        need = agreeing(width, self.share)
        if high - low < width:
            return None
        same = own[low:high] == hashes[low + diagonal : high + diagonal]
        sums = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(sums[width:] - sums[:-width] >= need)
        if not len(good):
            return None
        begin, end = int(good[0]), int(good[-1]) + width
        return low + begin + diagonal, low + begin, end - begin, int(sums[end] - sums[begin])


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, overlap: int = OVERLAP, share: float = SHARE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, n_words, n_equal: the best overlap of each document and item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; words ignore
    the case of A-Z. Best is the overlap with most equal words, then the first
    in the document. An item of fewer than ``overlap`` words must be there whole,
    with as large a share of its words; one of fewer than 7 words word for word;
    one of a word or two must be the whole document. Items go to the tasks in blocks of about ``block_bytes`` of
    text, one pass over the documents for each block. Null or empty texts, on
    either side, overlap nothing; a repeated document row gives repeated rows.
    """
    masks_for(overlap, share)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = [
        _against(rows, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n), overlap, share)
        for n in range(blocks)
    ]
    if blocks == 1:
        return parts[0]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    best = F.max_by(F.struct("doc_start", "item_start", "n_words", "n_equal"), F.struct("n_equal", -F.col("doc_start")))
    return whole.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def _against(docs: DataFrame, items: DataFrame, least: int, share: float) -> DataFrame:
    block = items.toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")]).combine_chunks()
    ids, texts = block.column("item_id").to_pylist(), block.column("text").cast(pa.large_string()).combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast((ids, texts.to_pylist()))
    names = ("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(shared.value[0], pa.array(shared.value[1], pa.large_string()), least, share)
        for part in arrow.slices(batches, "text"):
            words = read_words(part.column("text"))
            hashes = words.hashes(fold=True)
            first = words.first
            best: dict[tuple[int, int | None], tuple] = {}
            for text, item, diagonal in known.diagonals(hashes, words.sizes).tolist():
                own = hashes[first[text] : first[text] + words.sizes[text]]
                found = known.overlap(own, item, diagonal)
                key = (text, known.ids[item])
                if found and (key not in best or (found[3], -found[0]) > (best[key][3], -best[key][0])):
                    best[key] = found
            if best:
                doc = part.column("doc_id").take(pa.array([k[0] for k in best]))
                rest = zip(*((k[1], *v) for k, v in best.items()))
                yield arrow.batch(schema, doc, *[pa.array(c, pa.int64()) for c in rest])

    return docs.mapInArrow(find, ", ".join(f"{n} bigint" for n in names))
