"""Vectorised word hashing over whole Arrow text columns.

The text of many documents is one byte buffer. A table of 256 flags says which
bytes belong to words, so words of any length are found with array operations, and
a word's hash is the difference of two running sums of ``value[byte] * B**i``,
shifted back by ``B**-start``. No Python string is made for a word. Null text counts
as empty. Work goes in slices of a few megabytes, so memory follows the slice (or
the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C55)
_BASE_INV = U(pow(int(BASE), -1, 1 << 64))
_SEED = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
PLACE = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64) | U(1)
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*excluded: tuple[int, int]) -> np.ndarray:
    """True for every byte outside the excluded ranges (ends included)."""
    flags = np.ones(256, dtype=bool)
    for lo, hi in excluded:
        flags[lo:hi + 1] = False
    return flags


#: Words of non-blank characters, and words of letters and digits.
NON_BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_powers: dict[str, np.ndarray] = {"b": np.ones(1, U), "i": np.ones(1, U)}


def _pow(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        a = np.full(n, BASE if kind == "b" else _BASE_INV, dtype=U)
        a[0] = U(1)
        _powers[kind] = np.cumprod(a)
    return _powers[kind][:n]


@dataclass
class Words:
    """Words of the documents of one slice, in text order."""

    buf: np.ndarray        # bytes of all documents (lower-cased), end to end
    doc_start: np.ndarray  # byte where each document starts, and the end
    start: np.ndarray      # byte where each word starts
    end: np.ndarray        # byte after each word
    hash: np.ndarray       # 64-bit word hash
    first: np.ndarray      # first word of each document, and the number of words

    @property
    def docs(self) -> int:
        return len(self.doc_start) - 1

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.count())

    def text(self, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi`` (excluded), joined with one blank."""
        return b" ".join(self.buf[s:e].tobytes() for s, e in zip(self.start[lo:hi], self.end[lo:hi]))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    at = np.frombuffer(offs, dtype=np.int64, count=len(col) + 1, offset=col.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words_of(col: pa.Array, word_byte: np.ndarray, lower: bool = True) -> Words:
    """Hash every word of a text column, with A-Z lower-cased unless ``lower`` is false."""
    raw, at = column_bytes(col)
    n = len(raw)
    buf = LOWER[raw] if lower else raw
    inside = word_byte[buf]
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cut = at[(at > 0) & (at < n)]
        begins[cut] |= inside[cut]
        ends[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    run = np.zeros(n + 1, dtype=U)
    np.cumsum(BYTE_VALUE[buf] * _pow("b", n), out=run[1:])
    h = mix((run[end] - run[start]) * _pow("i", n + 1)[start] + (end - start).astype(U))
    return Words(buf, at, start, end, h, np.searchsorted(start, at))


def windows(w: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (over document ends too)."""
    m = len(w) - size + 1
    if m <= 0:
        return np.zeros(0, dtype=U)
    out = np.full(m, U(size), dtype=U)
    for j in range(size):
        out += mix(w[j:j + m] + PLACE[j % 64]) * PLACE[(j * 7 + 3) % 64]
    return mix(out)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of text, or one row."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, at = column_bytes(b.column(text))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi
