"""Texts of an Arrow batch as flat bytes, and the words in them.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. In UTF-8 this is the same as a run of
such characters, so words are found without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (used as pa.compute)

KEEP = np.ones(256, bool)
KEEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

SLICE_BYTES = 2 << 20  # text handled at once; a longer single document is handled alone


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about SLICE_BYTES of text, whole documents only."""
    sizes = batch.column(column).cast(pa.large_binary()) if batch.num_rows else None
    if sizes is None:
        return
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), np.int64)
    part = np.cumsum(lengths) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    del sizes
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets into them; null counts as empty."""
    return _flat(pa.compute.fill_null(column, "").cast(pa.large_string()))


def flat_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As flat, of a binary column."""
    return _flat(pa.compute.fill_null(column, b"").cast(pa.large_binary()))


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document where its words begin (n + 1 numbers)."""
    keep = KEEP[raw]
    first, last = keep.copy(), keep.copy()
    first[1:] &= ~keep[:-1]
    last[:-1] &= ~keep[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = keep[heads]
    last[tails] = keep[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 .. base ** n - 1 modulo 2 ** 64, kept between calls."""
    size = 1 << max(16, (n - 1).bit_length())
    for key in [k for k in _POWERS if k[0] == base and k[1] < size]:
        del _POWERS[key]
    if (base, size) not in _POWERS:
        x = np.full(size, base, np.uint64)
        x[0] = 1
        _POWERS[base, size] = np.multiply.accumulate(x)
    return _POWERS[base, size][:n]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hash of each values[start:end]; equal spans get equal hashes wherever they stand."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(n, base), out=sums[1:])
    inverse = powers(n + 1, pow(base, -1, 1 << 64))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(BYTE_VALUES[raw], starts, ends)


word_hash = byte_hash
