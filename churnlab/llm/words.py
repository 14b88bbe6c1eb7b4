"""Vectorised word splitting and hashing of Arrow string columns.

A word is a maximal run of bytes that are not separators; by default the
separators are the ASCII blanks ``\\x20 \\x09-\\x0D``, so words are those of the
pattern ``[^\\x20\\x09-\\x0D]+``. Every function works on whole texts; a batch is
cut between documents into slices of a few MB, so that the working arrays of a
task stay small whatever the batch size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
MASK = (1 << 64) - 1


def _splitmix(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers from a fixed rule."""
    out, x = np.empty(n, np.uint64), seed & MASK
    for i in range(n):
        x = (x + 0x9E3779B97F4A7C15) & MASK
        z = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & MASK
        out[i] = z ^ (z >> 31)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32                         # A-Z as a-z
_SEP = np.zeros(256, bool)
_SEP[list(BLANKS)] = True
# separators of folded words: every ASCII byte that is not a letter or a digit
_SEP_FOLDED = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
# keeps the first n bytes of eight
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words of some documents: hash, start and end byte per word, and for
    document i the words ``first[i]:first[i + 1]`` and the bytes
    ``off[i]:off[i + 1]`` of ``data``. ``base`` is the row of document 0 within
    the batch."""
    base: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    off: np.ndarray

    def __len__(self):
        return len(self.first) - 1

    @property
    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def ngrams(self, k: int, seed: int = 23) -> np.ndarray:
        """Hash of the k words starting at each word, for the positions 0 ..
        words - k; those that cross a document's end are to be masked by
        ``starts(k)``."""
        return ngrams(self.hash, k, seed)

    def starts(self, k: int) -> np.ndarray:
        """True where k words of one document start."""
        n = len(self.hash)
        ok = np.zeros(n, bool)
        if n:
            last = np.repeat(self.first[1:], np.diff(self.first))
            ok = np.arange(n) + k <= last
        return ok


def ngrams(h: np.ndarray, k: int, seed: int = 23) -> np.ndarray:
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    c = _splitmix(k, seed) | np.uint64(1)
    out = h[:n] * c[0]
    for j in range(1, k):
        out += h[j:j + n] * c[j]
    return mix(out)


def split(col: pa.Array, lower: bool = False, folded: bool = False) -> Iterator[Words]:
    """Words of each document of a string column, in slices of documents.

    ``lower`` hashes A-Z like a-z; ``folded`` also takes every ASCII
    character that is no letter or digit as a separator. Nulls have no words.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("") if col.null_count else col
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + SLICE_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield _words(lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], lower or folded,
                     _SEP_FOLDED if folded else _SEP)
        lo = hi


def _words(base: int, b: np.ndarray, off: np.ndarray, lower: bool, seps: np.ndarray) -> Words:
    n = len(b)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(base, b, z, z, np.zeros(0, np.uint64), np.zeros(len(off), np.int64), off)
    inside = ~seps[b]
    edge = np.zeros(n + 1, bool)            # a document starts here
    edge[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()                    # last byte of a word
    stop[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(start)
    e = np.flatnonzero(stop) + 1
    if len(s) == 0:
        return Words(base, b, s, e, np.zeros(0, np.uint64), np.zeros(len(off), np.int64), off)
    eight = np.zeros(n + 8, np.uint8)       # so that eight bytes can be read at any byte
    np.take(_LOWER, b, out=eight[:n]) if lower else np.copyto(eight[:n], b)
    at = np.ndarray((n,), "<u8", eight, strides=(1,))
    size = e - s
    h = mix((at[s] & _FIRST[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD)
    more = np.flatnonzero(size > 8)
    done = 8
    while len(more):                        # the next eight bytes of the longer words
        left = size[more] - done
        h[more] = mix(h[more] * _ODD + (at[s[more] + done] & _FIRST[np.minimum(left, 8)]))
        more, done = more[left > 8], done + 8
    return Words(base, b, s, e, h, np.searchsorted(s, off), off)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit keys as Spark longs."""
    return x.view(np.int64)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
