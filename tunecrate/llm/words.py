"""Words, shingles and hashes of whole columns of texts, as numpy arrays over Arrow buffers.

A word is a run of bytes other than ASCII space and 0x09-0x0D. Nothing here knows Spark;
the functions serve ``mapInArrow`` bodies, which see one bounded batch at a time.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SHORT = 64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Powers:
    """Powers of the hash base and of its inverse, grown as texts need them."""

    size = 0
    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > cls.size:
            cls.size = max(n, SLICE_BYTES + 1)
            cls.up, cls.down = _powers(_BASE, cls.size), _powers(_BASE_INVERSE, cls.size)
        return cls.up, cls.down


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Gives freed memory back to the system: Python workers live long and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def filled(column: pa.Array) -> pa.Array:
    """Texts with null as the empty text."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def byte_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of whole texts of about ``size`` bytes.

    A text longer than ``size`` is a run of its own.
    """
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
    release_memory()


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the number of words before it (one more entry at the end).

    ``between``: which of the 256 bytes part words.
    """
    space = between[data]
    begins, ends = ~space, ~space
    if len(data):
        begins[1:] &= space[:-1]
        ends[:-1] &= space[1:]
        full = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        begins[first] = ~space[first]
        ends[last] = ~space[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand.

    Spans of up to ``SHORT`` bytes: a polynomial modulo 2^64. Longer ones can be built to collide
    in it whatever its base (Thue-Morse words of 1,024 bytes do), so they get their own digest.
    """
    up, down = Powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=total[1:])
    sizes = ends - starts
    out = mix((total[ends] - total[starts]) * down[starts] + sizes.astype(np.uint64) * _STEP)
    long = np.flatnonzero(sizes > SHORT)
    if len(long):
        raw = data.tobytes()
        digests = (hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist()))
        out[long] = np.frombuffer(b"".join(digests), "<u8")
    return out


def shingle_hashes(hashes: np.ndarray, word_offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``width`` words inside a text, and shingle offsets per text.

    A text of one to ``width - 1`` words is one shingle of all its words; a text without words has none.
    """
    counts = np.diff(word_offsets)
    n_shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n_shingles)])
    first = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - word_offsets[:-1], n_shingles)
    if not len(first):
        return np.zeros(0, np.uint64), first, offsets
    end = np.repeat(word_offsets[1:], n_shingles)
    out = np.zeros(len(first), np.uint64)
    for k in range(width):
        at = first + k
        inside = at < end
        out = out * _STEP + np.where(inside, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
    return mix(out), first, offsets


def sums_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of true flags in each [offsets[i], offsets[i + 1])."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
