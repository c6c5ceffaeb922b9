"""Evidence for a rejection: every place where a term of the list occurs in a text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.matching import matcher
from ..functions.patterns import Term, TermList, exact_pattern
from ..runtime import spread
from .termindex import _DROPPED, _TABLE, _WIDE_GAPS, fold, text_slices

CONTEXT = 30

_DROPPED_BYTES = np.zeros(256, bool)
_DROPPED_BYTES[list(_DROPPED)] = True


def _starts(lowered: str) -> tuple[str, np.ndarray]:
    """The folded text, one character for each byte, and the place in ``lowered`` that each comes from."""
    data = lowered.encode("utf-8", "surrogatepass")
    letters = np.frombuffer(data, np.uint8)
    kept = ~_DROPPED_BYTES[letters]
    if not lowered.isascii():
        for gap in _WIDE_GAPS:
            at = data.find(gap)
            while at >= 0:
                kept[at : at + len(gap)] = False
                at = data.find(gap, at + len(gap))
    places = np.cumsum((letters & 0xC0) != 0x80, dtype=np.int32) - 1
    folded = np.frombuffer(data.translate(_TABLE), np.uint8)[kept]
    return folded.tobytes().decode("latin-1"), places[kept]


def term_spans(
    docs: DataFrame, terms: TermList, key: str = "doc_id", text: str = "text", context: int = CONTEXT
) -> DataFrame:
    """``key``, ord, term, start, end, match, context: all matches of each term in the rejected texts.

    Places count characters from 0, ``end`` is behind the match; matches of one
    term don't overlap, those of different terms may. ``context`` is the match
    with up to that many characters on either side, as the text has them. Texts
    that no term rejects have no rows. An automaton over the folded terms reads a
    text once and names the places where a term may start; the term's exact
    pattern decides there. Texts are screened and read a few megabytes at a time,
    in one pass of one Python worker.
    """
    blocked = matcher(terms)
    listed = [(t.ord, t.term, t.whole_word) for t in terms.terms]
    kind = docs.select(key).schema.add("ord", "long").add("term", "string").add("start", "integer").add("end", "integer")
    kind = kind.add("match", "string").add("context", "string")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        import pyarrow.compute as pc

        automaton, patterns, loose = ahocorasick.Automaton(), [], []
        for n, (_, term, whole) in enumerate(listed):
            patterns.append(re.compile(exact_pattern(Term(0, term, "", whole))))
            name = fold(term).decode("latin-1")
            # A term that begins with a gap, or is none but gaps, starts before its folded form.
            if not name or not fold(term[0]):
                loose.append(n)
            else:
                automaton.add_word(name, (*automaton.get(name, ()), n))
        if len(automaton):
            automaton.make_automaton()
        sizes = [len(fold(term)) for _, term, _ in listed]
        for batch in text_slices(batches, 1):
            rows, found = [], []
            lowered = pc.utf8_lower(batch.column(1))
            hits = pa.array(np.flatnonzero(blocked(lowered)))
            batch, lowered = batch.take(hits), lowered.take(hits).to_pylist()
            for row, (own, whole) in enumerate(zip(batch.column(1).to_pylist(), lowered)):
                places: dict[int, list[int]] = {}
                if len(automaton):
                    short, at = _starts(whole)
                    for end, names in automaton.iter(short):
                        for n in names:
                            places.setdefault(n, []).append(int(at[end - sizes[n] + 1]))
                spans = []
                for n, candidates in places.items():
                    last = 0
                    for start in sorted(set(candidates)):
                        match = patterns[n].match(whole, start) if start >= last else None
                        if match:
                            spans.append((n, start, match.end()))
                            last = max(match.end(), start + 1)
                for n in loose:
                    spans += [(n, m.start(), m.end()) for m in patterns[n].finditer(whole)]
                for n, start, end in sorted(spans):
                    rows.append(row)
                    found.append((listed[n][0], listed[n][1], start, end, own[start:end], own[max(0, start - context) : end + context]))
            columns = list(zip(*found)) if found else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                [key, "ord", "term", "start", "end", "match", "context"],
            )

    return spread(docs.select(key, text)).mapInArrow(find, kind)
