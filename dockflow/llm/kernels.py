"""Vectorised text kernels shared by the operators (numpy over Arrow buffers).

A kernel sees a *slice*: whole documents, concatenated as UTF-8 bytes, with
``off[i]:off[i+1]`` as the bytes of document ``i``. Words are maximal runs of
bytes outside ``\\x20`` and ``\\x09-\\x0D``; lower-casing touches A-Z only, so
both work on bytes. Memory is proportional to one slice (``SLICE_BYTES``, or
the longest single document).
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse mod 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: a bijection that spreads every input bit."""
    x = np.asarray(x, U).copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


_BYTE = seeds(256, 11)
_Q = seeds(16, 12)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, grown on demand by doubling."""
    if not _powers:
        _powers["p"] = np.ones(1, U)
        _powers["q"] = np.ones(1, U)
    inv = pow(_BASE, -1, 1 << 64)
    for name, base in (("p", _BASE), ("q", inv)):
        t = _powers[name]
        while len(t) < n:
            t = np.concatenate([t, t * U(pow(base, len(t), 1 << 64))])
        _powers[name] = t
    return _powers["p"], _powers["q"]


def text_views(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, obuf, dbuf = col.buffers()
    off = np.frombuffer(obuf, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(dbuf, np.uint8) if dbuf is not None and dbuf.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole documents of about ``limit`` bytes: (first, past, bytes, offsets)."""
    if not batch.num_rows:
        return
    data, off = text_views(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, off: np.ndarray, outside: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word of a slice, in order; ``outside`` flags the byte values between words."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~outside[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(off, start, side="right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span (A-Z folded when ``lower``): prefix sums of a
    polynomial hash, so the cost is linear in the bytes whatever the spans are."""
    p, q = _power_tables(len(data) + 1)
    v = _BYTE[_LOWER[data] if lower else data] * p[:len(data)]
    c = np.zeros(len(data) + 1, U)
    np.cumsum(v, out=c[1:])
    return mix((c[end] - c[start]) * q[start] + (end - start).astype(U) * _Q[15])


def doc_bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """``n + 1`` positions: the words of document i are ``bounds[i]:bounds[i+1]``."""
    return np.searchsorted(doc, np.arange(n + 1))


def window_hashes(words: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width``-word window inside one document: (hash, first word)."""
    m = len(words) - width + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:m] == doc[width - 1:])
    h = np.zeros(len(at), U)
    for j in range(width):
        h += words[at + j] * _Q[j]
    return mix(h), at


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All ``width``-word shingles, (hash, document) in document order; a document
    with fewer words gives its whole sequence as one, without words none."""
    h, at = window_hashes(words, doc, width)
    d = doc[at] if len(at) else np.zeros(0, np.int64)
    b = doc_bounds(doc, n_docs)
    n = np.diff(b)
    few = np.flatnonzero((n > 0) & (n < width))
    if len(few):
        s = np.zeros(len(few), U)
        for j in range(width - 1):
            has = n[few] > j
            s[has] += words[b[few[has]] + j] * _Q[j]
        s = mix(s + n[few].astype(U) * _Q[14])
        h, d = np.concatenate([h, s]), np.concatenate([d, few])
        o = np.argsort(d, kind="stable")
        h, d = h[o], d[o]
    return h, d


def distinct_per_doc(h: np.ndarray, d: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each document: (hash, document)."""
    b = np.searchsorted(d, np.arange(n_docs + 1))
    parts = [np.unique(h[b[i]:b[i + 1]]) for i in range(n_docs)]
    return (np.concatenate(parts) if parts else h[:0],
            np.repeat(np.arange(n_docs), [len(x) for x in parts]))


def arrow_map(fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]):
    """A ``mapInArrow`` function that applies ``fn`` to each batch and drops empty results."""
    def run(batches):
        for batch in batches:
            for out in fn(batch):
                if out.num_rows:
                    yield out
    return run


def trim() -> None:
    """Hand freed memory back to the system (where the C library can), so that a worker that is kept for later
    tasks doesn't keep its largest task's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def packed(a: np.ndarray) -> bytes:
    """Unsigned integers, compressed: differences (when sorted), as byte planes, deflated."""
    rising = len(a) == 0 or bool((a[1:] >= a[:-1]).all())
    d = np.diff(a, prepend=a.dtype.type(0)) if rising else a
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(len(d), a.itemsize).T)
    return bytes([rising]) + zlib.compress(planes.tobytes(), 1)


def unpacked(raw: bytes, dtype: type) -> np.ndarray:
    """What ``packed`` was given."""
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zlib.decompress(memoryview(raw)[1:]), np.uint8).reshape(size, -1)
    d = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(d, dtype=dtype) if raw[0] else d


def as_i64(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed number, for Spark's ``bigint``."""
    return x.view(np.int64) if x.dtype == U else x.astype(np.int64)
