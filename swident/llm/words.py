"""Vectorised word scanning of whole texts with numpy.

Texts of an Arrow batch are laid into one byte buffer, separated by a newline;
word bounds, 64-bit word hashes and n-gram hashes come from whole-array
operations, so no Python object is made for a word.  The two word classes used
in this package delimit by ASCII bytes only, so scanning UTF-8 bytes equals
scanning characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 19
_libc: ctypes.CDLL | None = None


def lean_memory() -> None:
    """Let this (worker) process give memory of large arrays back when freed, and what is free now.

    Python workers live on between tasks: Arrow's pool and the allocator's own
    growing threshold would otherwise keep each task's largest arrays.
    """
    global _libc
    if _libc is None:
        _libc = ctypes.CDLL(None)
        pa.set_memory_pool(pa.system_memory_pool())
        if hasattr(_libc, "mallopt"):
            _libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
            _libc.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def _delims(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for a, b in spans:
        table[a : b + 1] = True
    return table


#: `[^\x20\x09-\x0D]+`
SPACED = _delims((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing: A-Z count as letters)
ALNUM = _delims((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_RADIX = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RADIX, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_MULTIPLIERS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, U(base), dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 21:
            _powers[base] = have
    return have[:n]


@dataclass
class Slice:
    """Some texts laid out in one buffer, with the bounds of their words."""

    first: int  # row of the batch at which the slice begins
    buf: np.ndarray  # uint8, texts joined by a newline
    doc_start: np.ndarray
    doc_end: np.ndarray
    start: np.ndarray  # of each word
    end: np.ndarray
    doc: np.ndarray  # slice-relative document of each word
    bounds: np.ndarray  # words of document i: bounds[i] .. bounds[i + 1]

    @property
    def n_docs(self) -> int:
        return len(self.doc_start)

    def hashes(self, fold_case: bool) -> np.ndarray:
        """A 64-bit hash of each word's bytes (A-Z as a-z if fold_case)."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        n = len(self.buf)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum((_FOLDED if fold_case else _VALUES)[self.buf] * _power(_RADIX, n), out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * _power(_INVERSE, n)[self.start])

    def cuts(self, counts_per_byte: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each document."""
        sums = np.concatenate(([0], np.cumsum(counts_per_byte, dtype=np.int64)))
        return sums[self.doc_end] - sums[self.doc_start]


def scan(buf: np.ndarray, doc_start: np.ndarray, doc_end: np.ndarray, delims: np.ndarray, first: int) -> Slice:
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = ~delims[buf]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.concatenate((np.searchsorted(start, doc_start), [len(start)])).astype(np.int64)
    doc = np.repeat(np.arange(len(doc_start)), np.diff(bounds))
    return Slice(first, buf, doc_start, doc_end, start, end, doc, bounds)


def slices(column: pa.Array, delims: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow string column in slices of about `limit` bytes.

    Every text is whole within one slice; a text longer than the limit has a
    slice of its own.  Null is the empty text.
    """
    lean_memory()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    length = np.diff(at)
    if column.null_count:
        length = np.where(np.asarray(column.is_null()), 0, length)
    i = 0
    while i < len(length):
        total = np.cumsum(length[i : i + 65536] + 1)
        k = max(1, int(np.searchsorted(total, limit, side="right")))
        total = total[:k]
        buf = np.full(int(total[-1]), 10, dtype=np.uint8)
        doc_end = total - 1
        doc_start = doc_end - length[i : i + k]
        for a, s, n in zip(doc_start.tolist(), at[i : i + k].tolist(), length[i : i + k].tolist(), strict=True):
            buf[a : a + n] = raw[s : s + n]
        yield scan(buf, doc_start, doc_end, delims, i)
        i += k


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows that begin at each word (len(h) - n + 1)."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = h[:count] * _MULTIPLIERS[0]
    for j in range(1, n):
        out = out + h[j : j + count] * _MULTIPLIERS[j]
    return mix(out)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal significance together, which compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() if len(x) else b""


def joined(data: bytes, kind: type) -> np.ndarray:
    """The array that planes() took apart."""
    n = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(n, -1).T).view(kind).ravel() if data else np.zeros(0, kind)
