"""Words of whole texts as arrays: borders, hashes and rolling hashes, without a Python object for each word.

A word is a run of bytes other than space and 0x09 to 0x0D in the UTF-8 text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Odd multipliers of the polynomial hashes of bytes in a word and of words in a window.
_BYTE_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD_STEP = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
# Words hashed at a time, so the arrays over their bytes stay small.
CHUNK_WORDS = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(which: int, fold: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_STEP[which]))
    if fold:
        table[65:91] = table[97:123]
    return table


_TABLES = {(w, f): _letters(w, f) for w in (0, 1) for f in (False, True)}
_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(step: int, count: int) -> np.ndarray:
    """1, step, step squared, ... modulo 2**64."""
    key = (step, max(1024, 1 << (count - 1).bit_length() if count else 0))
    if key not in _powers:
        run = np.full(key[1], step, np.uint64)
        run[0] = 1
        _powers[key] = np.multiply.accumulate(run)
        for other in [k for k in _powers if k[0] == step and k[1] < key[1]]:
            del _powers[other]
        if key[1] > 1 << 20:  # of a very long text: not kept
            return _powers.pop(key)[:count]
    return _powers[key][:count]


@dataclass
class Words:
    """Words of some texts, one text after the other."""

    data: np.ndarray  # the bytes of all texts
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    sizes: np.ndarray  # words of each text

    @property
    def first(self) -> np.ndarray:
        """The number of each text's first word."""
        return np.cumsum(self.sizes) - self.sizes

    def hashes(self, which: int = 0, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` picks one of two independent ones, ``fold`` ignores case of A-Z."""
        out = np.empty(len(self.starts), np.uint64)
        for low in range(0, len(out), CHUNK_WORDS):
            starts, ends = self.starts[low : low + CHUNK_WORDS], self.ends[low : low + CHUNK_WORDS]
            lengths = ends - starts
            heads = np.cumsum(lengths) - lengths
            inside = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
            letters = self.data[np.repeat(starts, lengths) + inside]
            terms = _TABLES[which, fold][letters] * powers(_BYTE_STEP[which], int(lengths.max()))[inside]
            out[low : low + CHUNK_WORDS] = mix(np.add.reduceat(terms, heads))
        return out

    def bytes_of(self, low: int, high: int) -> bytes:
        return self.data[self.starts[low] : self.ends[high - 1]].tobytes() if high > low else b""


def read_words(texts: pa.Array) -> Words:
    """Words of a string array; a null has none."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    inner = ~_SPACE[data]
    fresh = np.ones(len(data) + 1, bool)  # whether a word cannot go on from the byte before
    fresh[1:-1] = ~inner[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(inner & fresh[:-1])
    closing = np.ones(len(data), bool)
    closing[:-1] = ~inner[1:]
    closing[offsets[(offsets > 0)] - 1] = True
    ends = np.flatnonzero(inner & closing) + 1
    sizes = np.diff(np.searchsorted(starts, offsets))
    return Words(data, starts, ends, sizes)


def rolling(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of every ``width`` consecutive items; item i's window begins at i (across texts, too)."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    step = _WORD_STEP[which]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(step, len(hashes)), out=sums[1:])
    back = powers(pow(step, -1, 1 << 64), count)
    return mix((sums[width:] - sums[:-width]) * back + np.uint64(width))
