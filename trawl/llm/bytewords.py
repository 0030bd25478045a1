"""Words of UTF-8 texts as numpy arrays, for the operators that work on Arrow batches.

Splitting on ASCII classes is done on bytes: a byte of a multi-byte character is never an
ASCII byte, so byte-wise classes give the same words as code points. Texts are handled
whole, in chunks of about ``CHUNK_BYTES`` that bound the working arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Word bytes of [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (applied after lower-casing A-Z)
LETTERS_DIGITS = np.zeros(256, dtype=bool)
LETTERS_DIGITS[48:58] = LETTERS_DIGITS[97:123] = LETTERS_DIGITS[128:] = True

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # bases of the two word hashes
_NGRAM_ODD = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # bases of the two n-gram hashes
_U = np.uint64


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) in runs of about ``limit`` bytes, a text never cut.
    Only one run's texts are Python objects at a time."""
    size = pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size + 1)
    first = 0
    while first < len(column):
        before = total[first - 1] if first else 0
        n = int(np.searchsorted(total, before + limit)) + 1 - first
        yield first, as_bytes(column.slice(first, n))
        first += n


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public domain constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2)), base, dtype=np.uint64)
        p[0] = 1
        have = _POWERS[base] = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def _range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], one prefix sum for all ranges."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=total[1:])
    return (total[ends] - total[starts]) * _powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


class Words:
    """The words of some texts: byte ranges in one buffer and the first word of every text."""

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray, lower: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        inside = np.empty(len(self.buf) + 1, dtype=np.int8)
        inside[0] = 0
        inside[1:] = word_bytes[self.buf]
        step = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        at = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        self.text_at = at[:-1]
        self.first = np.searchsorted(self.starts, at)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of every word."""
        h = _range_hash(self.buf.astype(np.uint64) + _U(1), self.starts, self.ends, _ODD[which])
        return mix64(h ^ ((self.ends - self.starts).astype(np.uint64) << _U(56)))

    def text_of_word(self) -> np.ndarray:
        """The index of the text that holds each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ngram_hashes(hashes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every n consecutive word hashes (len - n + 1 of them)."""
    k = len(hashes) - n + 1
    if k <= 0:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(k)
    return mix64(_range_hash(hashes, starts, starts + n, _NGRAM_ODD[which]))
