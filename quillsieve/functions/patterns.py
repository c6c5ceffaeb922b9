"""Term and phrase lists, and the pattern of a term.

A term list is input data: callers bring their own rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .textnorm import WHITESPACE

# Look-alike characters accepted for a letter of a term.
SUBSTITUTIONS = {
    "a": "a@4^",
    "e": "e3&",
    "i": "i1!|y",
    "o": "o0*",
    "s": "s$5z",
    "t": "t7+",
    "l": "l1|",
    "u": "uv@*",
    "c": "ck",
    "k": "kc",
}

# Characters a space inside a term may stand for, any number of times.
GAP_CHARS = WHITESPACE + "-_"

# The phrases of the second screening pass.
DEFAULT_PHRASES = [
    "murder", "suicide", "self-harm", "sexual violence", "bank robber",
    "kill yourself", "killed himself", "killed herself",
    "rape", "rapist", "molest", "pedophil", "child abuse",
    "shoot guns", "drug dealer", "cocaine", "heroin", "methamphetamine",
    "kill her", "kill him", "torture", "dismember",
]

_GAP = "gap"
# Neighbours of a word boundary: (word character, anything else), once for those
# that are so for certain and once for all that may be. Classes of foreign letters
# would overflow the matching engine's state cache; see matching.py.
_CERTAIN = (r"[0-9A-Za-z_]", r"[\x00-/:-@\[-^`{-\x7f]")
_POSSIBLE = (r"[0-9A-Za-z_\x{80}-\x{10FFFF}]", r"[^0-9A-Za-z_]")


@dataclass(frozen=True)
class Term:
    ord: int
    term: str
    category: str = ""
    whole_word: bool = False


def _escape(ch: str) -> str:
    return "\\" + ch if ch.isascii() and not ch.isalnum() and not ch.isspace() else ch


def _char_class(chars: Iterable[str]) -> str:
    ordered = sorted(chars)
    if len(ordered) == 1:
        return _escape(ordered[0])
    return "[" + "".join(_escape(c) for c in ordered) + "]"


def _units(term: str) -> list:
    """The term as a sequence of character sets and gaps."""
    return [_GAP if ch == " " else frozenset(SUBSTITUTIONS.get(ch, ch)) for ch in term.lower()]


def term_pattern(term: str) -> str:
    """Pattern of a single term (no word boundaries)."""
    return "".join(
        _char_class(GAP_CHARS) + "*" if unit == _GAP else _char_class(unit) for unit in _units(term)
    )


@dataclass(frozen=True)
class TermList:
    """Terms in list order, duplicates (ignoring case) removed, first one kept."""

    terms: tuple[Term, ...] = field(default=())

    @classmethod
    def of(cls, rows: Iterable[Term]) -> TermList:
        first: dict[str, Term] = {}
        for row in sorted(rows, key=lambda r: r.ord):
            key = row.term.lower()
            if key and key not in first:
                first[key] = Term(row.ord, key, row.category, row.whole_word)
        return cls(tuple(first.values()))

    @classmethod
    def from_table(cls, df: DataFrame) -> TermList:
        """Read ``(ord, term, category, whole_word)`` rows. The list travels with the query to every task."""
        rows = df.select("ord", "term", "category", "whole_word").collect()
        return cls.of(Term(r.ord, r.term, r.category or "", bool(r.whole_word)) for r in rows)


def exact_pattern(term: Term) -> str:
    """Pattern of one term with word boundaries that know all letters."""
    body = term_pattern(term.term)
    return rf"\b{body}\b" if term.whole_word else body


def scan_patterns(term: Term) -> tuple[str, str]:
    """Patterns for an engine whose ``\\b`` knows ASCII only: sure and possible matches.

    They differ only where a foreign character touches a whole-word term. A
    boundary lies between a word character and anything else, so an edge that
    is a symbol needs a word character next to it and one that is a word
    character needs none. The neighbours are matched along.
    """
    if not term.whole_word:
        return term_pattern(term.term), term_pattern(term.term)
    if term.term != term.term.strip(" "):
        raise ValueError(f"a whole-word term starts or ends with a space: {term.term!r}")
    return _bounded(term, *_CERTAIN), _bounded(term, *_POSSIBLE)


def _bounded(term: Term, word_char: str, other_char: str) -> str:
    units = [
        (_char_class(GAP_CHARS) + "*", frozenset(GAP_CHARS)) if u == _GAP else (_char_class(u), u)
        for u in _units(term.term)
    ]

    def edges(chars: frozenset) -> list[tuple[str, bool]]:
        """The edge unit split into word characters and symbols."""
        word = {c for c in chars if c.isalnum() or c == "_"}
        split = [(word, True), (chars - word, False)]
        return [(_char_class(part), is_word) for part, is_word in split if part]

    def before(is_word: bool) -> str:
        return f"(?:^|{other_char})" if is_word else word_char

    def after(is_word: bool) -> str:
        return f"(?:{other_char}|$)" if is_word else word_char

    first, last = edges(units[0][1]), edges(units[-1][1])
    if len(units) == 1:
        return "|".join(before(w) + chars + after(w) for chars, w in first)
    middle = "".join(pattern for pattern, _ in units[1:-1])
    heads = "|".join(before(w) + chars for chars, w in first)
    tails = "|".join(chars + after(w) for chars, w in last)
    return f"(?:{heads}){middle}(?:{tails})"


def phrase_pattern(phrase: str) -> str:
    """A phrase stands for itself: no boundaries, no substitutions."""
    return "".join(_escape(ch) for ch in phrase)
