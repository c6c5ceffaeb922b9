"""Term and phrase matching over whole columns, in Arrow batches.

Java's regex engine backtracks and manages a few MB/s per core on a list of
hundreds of terms. The linear-time engine behind Arrow's string kernels scans
the same list some ten times faster, transfer included, so documents are
matched there: one text column goes out, one flag or term comes back, and all
other columns stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, functions as F

from .patterns import TermList, exact_pattern, phrase_pattern, scan_patterns

# Pattern characters combined into one automaton. Measured: lists four times as
# long overflow the engine's state cache and run hundreds of times slower.
CHUNK_CHARS = 8_000
# Bytes of text that are lowered and matched at a time, whatever the batches Spark sends.
SLICE_BYTES = 2 << 20


def _kernel(names: list[str], sure: list[str], possible: list[str], exact: list[str]):
    """Functions over a lowered Arrow array; nested, so that they ship by value."""
    chunk = CHUNK_CHARS
    unsure = [i for i in range(len(names)) if sure[i] != possible[i]]

    def scan(lowered, patterns: list[str]):
        import numpy as np
        import pyarrow.compute as pc

        found = np.zeros(len(lowered), dtype=bool)
        start = 0
        while start < len(patterns):
            end, size = start + 1, len(patterns[start])
            while end < len(patterns) and size + len(patterns[end]) < chunk:
                size += len(patterns[end])
                end += 1
            part = pc.match_substring_regex(lowered, "|".join(patterns[start:end]))
            found |= pc.fill_null(part, False).to_numpy(zero_copy_only=False)
            start = end
        return found

    def hits(lowered, low: int, high: int):
        """Which texts contain any of the terms ``low..high-1``; null counts as clean.

        The few texts in which a whole-word term only touches foreign characters
        are decided one by one.
        """
        import re

        import numpy as np
        import pyarrow as pa

        found = scan(lowered, sure[low:high])
        words = [i for i in unsure if low <= i < high]
        if words:
            rest = np.flatnonzero(~found)
            open_texts = lowered.take(pa.array(rest))
            maybe = np.flatnonzero(scan(open_texts, [possible[i] for i in words]))
            decide = None
            for at in maybe:
                if decide is None:
                    decide = re.compile("|".join(exact[i] for i in words))
                found[rest[at]] = decide.search(open_texts[int(at)].as_py()) is not None
        return found

    def first(lowered):
        """First matching term in list order, narrowed down by halves of the list."""
        import numpy as np
        import pyarrow as pa

        result = np.full(len(lowered), None, dtype=object)
        matched = np.flatnonzero(hits(lowered, 0, len(names)))
        open_ranges = [(matched, 0, len(names))]
        while open_ranges:
            rows, low, high = open_ranges.pop()
            if not len(rows):
                continue
            if high - low == 1:
                result[rows] = names[low]
                continue
            middle = (low + high) // 2
            front = hits(lowered.take(pa.array(rows)), low, middle)
            open_ranges += [(rows[front], low, middle), (rows[~front], middle, high)]
        return pa.array(result, pa.string())

    return hits, first


def _slicer():
    """A function over an Arrow array of texts; nested, so that it ships by value."""
    most = SLICE_BYTES

    def sliced(texts, answer):
        """``answer`` of the lowered texts, a few megabytes at a time."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        found = [answer(pc.utf8_lower(texts.slice(low, high - low))) for low, high in zip(cuts, cuts[1:])]
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(found)

    return sliced


def _compiled(terms: TermList) -> tuple[list[str], ...]:
    sure, possible = zip(*map(scan_patterns, terms.terms)) if terms.terms else ((), ())
    names = [t.term for t in terms.terms]
    return names, list(sure), list(possible), [exact_pattern(t) for t in terms.terms]


def _literal(phrases: Iterable[str]) -> tuple[list[str], ...]:
    phrases = list(phrases)
    patterns = [phrase_pattern(p) for p in phrases]
    return phrases, patterns, patterns, patterns


def _flag(text: Column, *lists: list[str]) -> Column:
    (hits, _), sliced = _kernel(*lists), _slicer()
    n_terms = len(lists[0])

    def flag(text: pa.Array) -> pa.Array:
        import pyarrow as pa

        return sliced(text, lambda lowered: pa.array(hits(lowered, 0, n_terms)))

    return F.arrow_udf(flag, "boolean")(text)


def _name(text: Column, *lists: list[str], once: bool = False) -> Column:
    (_, first), sliced = _kernel(*lists), _slicer()

    def name(text: pa.Array) -> pa.Array:
        return sliced(text, first)

    matching = F.arrow_udf(name, "string")
    return (matching.asNondeterministic() if once else matching)(text)


def matcher(terms: TermList):
    """A function that tells which texts of a lowered Arrow array contain any term, for use inside tasks."""
    hits, _ = _kernel(*_compiled(terms))
    n_terms = len(terms.terms)
    return lambda lowered: hits(lowered, 0, n_terms)


def blocked(text: Column, terms: TermList) -> Column:
    """True when any term occurs in the text (any case); null text counts as clean."""
    return _flag(text, *_compiled(terms))


def first_term(text: Column, terms: TermList, once: bool = False) -> Column:
    """The matching term that comes first in list order, else null.

    ``once`` keeps Spark from running it a second time, in another worker, for a filter on the result.
    """
    return _name(text, *_compiled(terms), once=once)


def has_phrase(text: Column, phrases: Iterable[str]) -> Column:
    """True when any phrase is a plain substring of the lowered text; null counts as clean.

    Built-in functions only: the texts stay in the JVM.
    """
    lowered = F.lower(text)
    found = reduce(lambda left, phrase: left | F.contains(lowered, F.lit(phrase)), phrases, F.lit(False))
    return F.coalesce(found, F.lit(False))


def first_phrase(text: Column, phrases: Iterable[str]) -> Column:
    """The first phrase of the list that occurs, else null."""
    return _name(text, *_literal(phrases))
