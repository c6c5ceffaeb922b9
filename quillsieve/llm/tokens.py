"""Token ids of whole texts, each distinct word encoded once per worker.

A byte-pair tokenizer never merges across the border between a word and the
white space before the next one, nor between a letter and a final comma or
stop. So a text is cut there, every distinct piece goes through the
``tokenizers`` library once, and the ids of a text are gathered from the
pieces. Texts with runs of white space, or white space other than spaces and
line ends, are encoded whole.
"""

from __future__ import annotations

import gc
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distinct pieces a worker remembers before it starts afresh (about 200 bytes each).
CACHE_PIECES = 400_000

# A mark after a letter or digit and before white space is a piece of its own.
_OWN = "\x02"
_MARK, _CUT = r"([\pL\pN])([.,;:!?])([ \n])", r"\1 " + _OWN + r"\2\3"

_loaded: dict[str, "PieceTokenizer"] = {}


def _byte_letters() -> dict[int, str]:
    """The visible letter by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class _Index(dict):
    """Piece -> row; unknown pieces get the next row and wait to be encoded."""

    def __init__(self, owner: "PieceTokenizer", prefix: str):
        super().__init__()
        self.owner, self.prefix = owner, prefix

    def __missing__(self, piece: str) -> int:
        if piece[:1] == "\n":
            chunk = piece
        elif piece[:1] == _OWN:
            chunk = piece[1:]
        else:
            chunk = self.prefix + piece
        row = self[piece] = self.owner.reserve(chunk)
        return row


class PieceTokenizer:
    """``encode(texts)`` returns the ids of all texts in one array, and their counts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.letters = _byte_letters()
        self.lead = self.letters[32] if self.raw([" a"]) != self.raw(["a"]) else ""
        self.split = self.library.model.tokenize
        self.normalize = self.library.normalizer and self.library.normalizer.normalize_str
        self.direct = True
        trial = ["a", " a", "Word", " Straße", "élan", " ünder", "abcdefghij", " ñ", "ǅ", " e\u0301"]
        self.direct = [self.word(t) for t in trial if t.strip().isalpha()] == self.raw(
            [t for t in trial if t.strip().isalpha()]
        )
        self.clear()

    def clear(self) -> None:
        self.inner, self.first = _Index(self, " "), _Index(self, "")
        self.waiting: list[str] = []
        self.known = 0
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)  # -1: texts with this piece are encoded whole
        self.pool = np.zeros(4096, np.uint32)
        self.used = 0

    def reserve(self, chunk: str) -> int:
        self.waiting.append(chunk)
        return self.known + len(self.waiting) - 1

    def raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, chunk: str) -> list[int]:
        """Ids of letters with at most one space before them: one call of the library's model."""
        if self.normalize is not None:
            chunk = chunk.lower() if chunk.isascii() else self.normalize(chunk)
        lead, body = (self.lead, chunk[1:]) if chunk[0] == " " else ("", chunk)
        if not body.isascii():
            body = body.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.split(lead + body)]

    def learn(self) -> None:
        if self.waiting:
            gc.disable()  # millions of small lists live only within this call
            try:
                self._learn()
            finally:
                gc.enable()

    def _learn(self) -> None:
        odd = np.zeros(len(self.waiting), bool)
        ids: list = [None] * len(self.waiting)
        for n, chunk in enumerate(self.waiting):
            body = chunk[1:] if chunk[:1] == " " else chunk
            if body.isalpha():
                if self.direct:
                    ids[n] = self.word(chunk)
            elif not body.isalnum():
                odd[n] = any(c.isspace() for c in chunk[1:]) or chunk[:1].isspace() and chunk[:1] not in " \n"
        left = [n for n, own in enumerate(ids) if own is None]
        for n, own in zip(left, self.raw([self.waiting[n] for n in left])):
            ids[n] = own
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        need, total = self.known + len(ids), self.used + int(counts.sum())
        if need > len(self.starts):
            self.starts = np.resize(self.starts, 2 * need)
            self.lengths = np.resize(self.lengths, 2 * need)
        if total > len(self.pool):
            self.pool = np.resize(self.pool, 2 * total)
        self.pool[self.used : total] = np.fromiter((i for one in ids for i in one), np.uint32, total - self.used)
        self.starts[self.known : need] = self.used + np.cumsum(counts) - counts
        self.lengths[self.known : need] = np.where(odd, -1, counts)
        self.known, self.used = need, total
        self.waiting.clear()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; a null is an empty text."""
        if self.known > CACHE_PIECES:
            self.clear()
        texts = pc.fill_null(texts, "")
        cut = pc.replace_substring(pc.replace_substring_regex(texts, _MARK, _CUT), "\n", " \n")
        odd_space = pc.or_(pc.match_substring(cut, "  "), pc.match_substring(texts, "\n\n"))
        edge_space = pc.or_(pc.starts_with(cut, " "), pc.ends_with(cut, " "))
        aside = pc.or_(pc.or_(odd_space, edge_space), pc.match_substring(texts, _OWN))
        whole = dict.fromkeys(np.flatnonzero(aside.to_numpy(zero_copy_only=False)).tolist())
        plain = pc.and_(pc.invert(aside), pc.not_equal(pc.binary_length(cut), 0))
        place = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        lists = pc.split_pattern(cut.filter(plain), " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        pieces = lists.flatten()
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = np.fromiter(map(self.inner.__getitem__, distinct), np.int64, len(distinct))
        flat = known[coded.indices.to_numpy()]
        heads = np.cumsum(sizes) - sizes
        flat[heads] = [self.first[p] for p in pieces.take(pa.array(heads)).to_pylist()]
        owner = np.repeat(place, sizes)
        self.learn()
        lengths = self.lengths[flat]
        for n in np.unique(owner[lengths < 0]).tolist():
            whole[n] = None
        if whole:
            keep = ~np.isin(owner, list(whole))
            flat, lengths, owner = flat[keep], lengths[keep], owner[keep]
        counts = np.bincount(owner, lengths, len(texts)).astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.starts[flat] - (ends - lengths), lengths) + np.arange(total)]
        if whole:
            edges = np.cumsum(counts)
            parts, at = [], 0
            for n, own in zip(whole, self.raw([texts[n].as_py() for n in whole])):
                whole[n] = np.array(own, np.uint32)
            for n in sorted(whole):
                parts += [ids[at : edges[n]], whole[n]]
                at, counts[n] = int(edges[n]), len(whole[n])
            ids = np.concatenate([*parts, ids[at:]])
        return ids, counts


def tokenizer(path: str) -> PieceTokenizer:
    """The worker's own copy of the tokenizer file at ``path``."""
    if path not in _loaded:
        _loaded[path] = PieceTokenizer(path)
    return _loaded[path]


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
