"""Vectorised word and n-gram hashing over Arrow string buffers.

Used inside ``mapInArrow`` tasks.  A batch is cut into slices of about ``CHUNK_BYTES`` of text, so
the scratch arrays stay small whatever the batch size; a single longer text forms its own slice.

A *word* is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r`` (the regex
``[^\\x20\\x09-\\x0D]+``; these bytes never occur inside a UTF-8 multi-byte character).
Hashes are 64-bit polynomial prefix hashes (odd base, so every power has an inverse and any
substring hash is one subtraction and one product) finished by a splitmix64 step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (a bijection on 64-bit values)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)

            def table(b):
                t = np.full(size, b, dtype=U64)
                t[0] = 1
                return np.cumprod(t, dtype=U64)

            self.up, self.down = table(self.base), table(self.inverse)
        return self.up[:n], self.down[:n]


_BYTE_POW, _WORD_POW = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES):
    """Cut a batch into row slices of at most ``max_bytes`` of text (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
        yield batch.slice(begin, stop - begin)
        begin = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and the row offsets (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, off - off[0]


def find_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the index of its first word (len rows + 1)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def byte_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each byte, for ``Grams`` over bytes."""
    return _BYTE_VALUE[data]


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word."""
    if len(starts) == 0:
        return np.zeros(0, dtype=U64)
    up, down = _BYTE_POW.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE_VALUE[data] * up[:-1], dtype=U64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


class Grams:
    """Hashes of any run of words (or bytes) of a slice: ``grams(start, stop)`` over their indexes."""

    def __init__(self, words: np.ndarray):
        self.up, self.down = _WORD_POW.get(len(words) + 1)
        self.total = np.zeros(len(words) + 1, dtype=U64)
        np.cumsum(words * self.up[:-1], dtype=U64, out=self.total[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(U64))


def gram_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at which a run of ``k`` words fits its row, and their row numbers."""
    n = np.diff(first)
    fits = np.maximum(n - k + 1, 0)
    row = np.repeat(np.arange(len(n)), fits)
    step = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits, fits)
    return np.repeat(first[:-1], fits) + step, row


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long of the same bits (Spark has no unsigned type)."""
    return x.view(np.int64)
