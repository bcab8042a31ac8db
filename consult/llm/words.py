"""Words, word hashes and shingle hashes of many texts at once (numpy, used inside tasks).

A word is a run of ASCII letters and digits (A-Z as a-z) and of all characters
beyond ASCII; everything else separates. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}
_SLOTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _class_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for a, b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        t[a:b + 1] = np.arange(a, b + 1)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    return t


_CLASS = _class_table()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        with np.errstate(over="ignore"):
            for k, b in (("p", _BASE), ("i", _INV)):
                a = np.full(max(n, 1 << 16), b, np.uint64)
                a[0] = 1
                _POW[k] = np.cumprod(a, dtype=np.uint64)
    return _POW["p"], _POW["i"]


class Words:
    """Words of several texts: ``hash``, byte ``start``/``end`` in ``buf``, and ``first[d]:first[d+1]`` per text."""

    def __init__(self, texts: list[bytes]):
        self.buf = b"\n".join(texts) + b"\n"
        n = len(texts)
        arr = _CLASS[np.frombuffer(self.buf, np.uint8)]
        word = np.empty(len(arr) + 2, np.int8)
        word[0] = word[-1] = 0
        word[1:-1] = arr != 0
        edge = np.diff(word)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _powers(len(arr) + 1)
        total = np.zeros(len(arr) + 1, np.uint64)
        np.cumsum(arr * power[:len(arr)], dtype=np.uint64, out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start] + length)
        at = np.zeros(n + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        self.byte_first = at
        self.first = np.searchsorted(self.start, at).astype(np.int64)

    def text_of_word(self) -> np.ndarray:
        """The index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def shingles(self, k: int = SHINGLE, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words, the word they begin at, and ``first`` per text.

        With ``short``, a text of 1 to k-1 words has one shingle, of all its words.
        """
        n, words = len(self.hash), np.diff(self.first)
        has = np.maximum(words - k + 1, 0)
        few = (words > 0) & (words < k) if short else np.zeros(len(words), bool)
        count = np.where(few, 1, has)
        first = np.zeros(len(words) + 1, np.int64)
        np.cumsum(count, out=first[1:])
        begin = np.arange(first[-1]) - np.repeat(first[:-1] - self.first[:-1], count)
        out = np.zeros(len(begin), np.uint64)
        last = np.repeat(self.first[1:], count) - 1
        pad = np.concatenate([self.hash, np.zeros(1, np.uint64)])
        for j in range(k):
            at = begin + j
            inside = at <= last
            out += np.where(inside, pad[np.minimum(at, n)], np.uint64(j + 1)) * (_SLOTS[j % 5] + np.uint64(2 * (j // 5)))
        return mix(out), begin, first


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Arrow batches cut into pieces of about ``size`` bytes of text, with the texts as bytes (null: empty)."""
    for b in batches:
        texts = [x or b"" for x in b.column(text).cast(pa.binary()).to_pylist()]
        lo = held = 0
        for i, t in enumerate(texts):
            held += len(t) + 1
            if held >= size:
                yield b.slice(lo, i + 1 - lo), texts[lo:i + 1]
                lo, held = i + 1, 0
        if lo < len(texts):
            yield b.slice(lo), texts[lo:]


def seeds(n: int, name: int) -> np.ndarray:
    """``n`` fixed 64-bit seeds of the family ``name``."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(name))
