"""Vectorised word splitting and hashing of Arrow string columns.

Words are maximal runs of bytes other than space and 0x09-0x0D; letters A-Z
are lower-cased.  All positions are byte positions in the column's own data
buffer, so a batch of documents is split in a few NumPy passes, never row by
row.  Word and shingle hashes are 64 bits wide: among n different words about
n*n / 2**65 pairs share a hash (under one in a million for five million words).
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C1B)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
#: Bytes hashed in one NumPy pass; longer batches are cut between documents.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_values(fold: bool) -> np.ndarray:
    byte = np.arange(256, dtype=np.uint64)
    if fold:
        byte[65:91] += np.uint64(32)
    return mix((byte + np.uint64(1)) * _BASE)


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        n = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            np.cumprod(table, out=table)
            _POWERS[name] = table
    return _POWERS["up"], _POWERS["down"]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and its n+1 document offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give memory that a task has freed back to the system: workers live on, and an executor has several."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Document ranges (first, last) of about `most` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of each word, in order."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    steps = inside[1:] != inside[:-1]
    # a document's last word must not run into the next document's first
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = np.unique(cut[inside[cut + 1] & inside[cut]])
    edges = np.flatnonzero(steps)
    if len(cut):
        edges = np.sort(np.concatenate([edges, cut, cut]), kind="stable")
    start, end = edges[0::2], edges[1::2]
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte range, by default case-folded for A-Z: a polynomial in the bytes' random values."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[fold][data] * down[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * up[start] + (end - start).astype(np.uint64))


def shingles(hashes: np.ndarray, doc: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes, sorted by document and hash, and their document numbers.

    A document of fewer words has one shingle, all its words; one without words has none.
    """
    size = np.bincount(doc, minlength=n)
    if len(hashes) >= k:
        out = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
        for i in range(k):
            out = (out + hashes[i : len(hashes) - k + 1 + i]) * _BASE
        out, owner = mix(out), doc[: len(out)]
        whole = owner == doc[k - 1 :]
        out, owner = out[whole], owner[whole]
    else:
        out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        first = np.searchsorted(doc, short)
        extra = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = size[short] > i
            extra[has] = (extra[has] + hashes[first[has] + i]) * _BASE
        out = np.concatenate([out, mix(extra + size[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    order = grouped_order(owner, out)
    out, owner = out[order], owner[order]
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[fresh], owner[fresh]


def grouped_order(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Positions sorted by owner, then value."""
    order = np.argsort(value)
    small = np.uint16 if len(owner) and int(owner.max()) < 65536 else np.int64
    return order[np.argsort(owner[order].astype(small), kind="stable")]
