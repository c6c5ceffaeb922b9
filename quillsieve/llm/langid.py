"""Language identification by cross-parsing entropy.

A suffix automaton is built from a sample of labelled text in each language. A
document is parsed, once for each language, into the longest phrases that occur
in the language's sample: the automaton walks as far as it can, then starts
again. The number of phrases times the cost of naming one, log2 of the sample's
length, is the number of bits the language needs; the one that needs the fewest
a character wins.

Texts are lower-cased; runs of anything but letters are one separator. Many
segments of texts walk all automata at the same time, a vector step a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillsieve.llm import arrow
from quillsieve.llm.quality import held_out

UNKNOWN = "und"
# Characters of sample text for a language, and of one document in it, at most.
SAMPLE_CHARS = 40_000
DOCUMENT_CHARS = 400
# Symbols of an automaton: the separator, frequent letters, and bins that other letters share.
LETTERS, BINS = 79, 16
# A parse starts anew after so many symbols, so long texts are spread over lanes.
SEGMENT = 1024


class SuffixAutomaton:
    """All substrings of a sequence of symbols, as a dense table: next state, or 0 where none follows (1 is the start)."""

    def __init__(self, symbols: list[int], alphabet: int):
        follow: list[dict[int, int]] = [{}, {}]
        link, length = [0, 0], [0, 0]
        last = 1
        for symbol in symbols:
            state = len(follow)
            follow.append({})
            link.append(1)
            length.append(length[last] + 1)
            at = last
            while at and symbol not in follow[at]:
                follow[at][symbol] = state
                at = link[at]
            if at:
                target = follow[at][symbol]
                if length[target] == length[at] + 1:
                    link[state] = target
                else:
                    copy = len(follow)
                    follow.append(dict(follow[target]))
                    link.append(link[target])
                    length.append(length[at] + 1)
                    while at and follow[at].get(symbol) == target:
                        follow[at][symbol] = copy
                        at = link[at]
                    link[target] = link[state] = copy
            last = state
        self.table = np.zeros((len(follow), alphabet), np.int32)
        for state, edges in enumerate(follow):
            if edges:
                self.table[state, list(edges)] = list(edges.values())


class Parser:
    """Automata of all languages in one table, and the symbols they share."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        frequent: dict[str, int] = {}
        for text in samples.values():
            for letter in text.lower():
                if letter.isalpha():
                    frequent[letter] = frequent.get(letter, 0) + 1
        self.codes = np.zeros(0x110000, np.uint8)
        letters = np.array([chr(c).isalpha() for c in range(0x110000)])
        rare = np.flatnonzero(letters)
        self.codes[rare] = 1 + LETTERS + rare % BINS
        for code, letter in enumerate(sorted(frequent, key=lambda x: (-frequent[x], x))[:LETTERS]):
            self.codes[ord(letter)] = 1 + code
        alphabet = 1 + LETTERS + BINS
        tables, self.starts, self.bits, base = [], [], [], 0
        for language in self.languages:
            symbols, _ = self.symbols([samples[language]])
            table = SuffixAutomaton(symbols.tolist(), alphabet).table
            tables.append(np.where(table > 0, table + base, 0))
            self.starts.append(base + 1)
            self.bits.append(np.log2(len(symbols) + 1))
            base += len(table)
        self.table = np.concatenate([np.zeros((1, alphabet)), *tables])[1:].astype(np.int32).reshape(-1)
        self.alphabet = alphabet

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the texts in a row, each with a separator at either end, and their counts."""
        joined = "".join(f" {t.lower()} " for t in texts)
        codes = self.codes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.fromiter((len(t.lower()) + 2 for t in texts), np.int64, len(texts))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
        keep[np.cumsum(sizes) - sizes] = True
        owner = np.repeat(np.arange(len(texts)), sizes)[keep]
        return codes[keep], np.bincount(owner, minlength=len(texts))

    def phrases(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Phrases of each text under each language."""
        per_text = -(-counts // SEGMENT)
        text = np.repeat(np.arange(len(counts)), per_text)
        rank = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin = (np.cumsum(counts) - counts)[text] + rank * SEGMENT
        size = np.minimum(SEGMENT, counts[text] - rank * SEGMENT)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        starts = np.array(self.starts, np.int64)[:, None]
        # State 0 leads nowhere: the next symbol begins a phrase.
        state = np.zeros((len(starts), len(begin)), np.int64)
        made = np.zeros(state.shape, np.int64)
        alive = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for step, lanes in enumerate(alive.tolist()):
            symbol = symbols[begin[:lanes] + step].astype(np.int64)
            after = self.table[state[:, :lanes] * self.alphabet + symbol]
            stuck = after == 0
            made[:, :lanes] += stuck
            state[:, :lanes] = np.where(stuck, self.table[starts * self.alphabet + symbol], after)
        total = np.zeros((len(counts), len(starts)))
        np.add.at(total, text[order], made.T)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and its share of the likelihood (2 to the power of minus the bits)."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        symbols, counts = self.symbols([t or "" for t in texts])
        bits = self.phrases(symbols, counts) * np.array(self.bits)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
        owner = np.repeat(np.arange(len(texts)), counts)
        lettered = np.bincount(owner, symbols > 0, len(texts)) > 0
        names = [self.languages[b] if x else UNKNOWN for b, x in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, share, 0.0)


_built: dict[int, Parser] = {}


def parser(samples: dict[str, str]) -> Parser:
    """The worker's automata for ``samples``, built once."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _built:
        _built.clear()
        _built[key] = Parser(samples)
    return _built[key]


def learn(docs: DataFrame, *, sample_chars: int = SAMPLE_CHARS, document_chars: int = DOCUMENT_CHARS) -> dict[str, str]:
    """Sample text of every language, from rows outside the held-out fold with a label (doc_id, text, lang).

    Documents are chosen by a hash of doc_id and text, so rows that share an id
    or have none are chosen one by one, and equal rows once. Of each about
    ``document_chars`` characters from a hashed place are used; of a language
    about twice as many as needed are read, until ``sample_chars`` are reached.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    place = F.xxhash64("doc_id", "text", F.lit(7)).bitwiseAND(F.lit((1 << 40) - 1))
    begin = F.pmod(F.xxhash64("text", F.lit(8)), F.greatest(F.length("text") - document_chars + 1, F.lit(1)))
    piece = F.substring(F.col("text"), (begin + 1).cast("int"), F.lit(document_chars))
    known = known.select("lang", place.alias("place"), F.length("text").alias("chars"), piece.alias("piece"))
    # Equal rows are combined before the shuffle of these narrow rows.
    each = known.groupBy("lang", "place").agg(F.least(F.max("chars"), F.lit(document_chars)).alias("chars"))
    volumes = each.groupBy("lang").agg(F.sum("chars").alias("chars"))
    # One row for each language: about twice the sample is read, whatever the size of the input.
    limits = volumes.where("chars > 0").select("lang", (F.lit(2.0) * sample_chars / F.col("chars") * (1 << 40)).alias("limit"))
    limits = {r["lang"]: r["limit"] for r in limits.collect()}
    if not limits:
        return {}
    limit = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
    drawn = known.where(F.col("place") < limit[F.col("lang")]).groupBy("lang", "place").agg(F.min("piece").alias("piece"))
    samples: dict[str, list[str]] = {}
    for row in sorted(drawn.collect(), key=lambda r: (r["lang"], r["place"], r["piece"])):
        samples.setdefault(row["lang"], []).append(row["piece"])
    return {language: "\n".join(parts)[:sample_chars] for language, parts in samples.items()}


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text).

    ``und`` with score 0 if the text is null or has no letter. Ties go to the
    first language in alphabetical order.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(samples)
        for part in arrow.slices(batches, "text"):
            names, share = own.predict(part.column("text").to_pylist())
            yield arrow.batch(schema, part.column("doc_id"), names, share)

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(name, "doc_id bigint, lang_pred string, score double")
