"""Vectorised text helpers for Arrow batches: slices, words, rolling hashes.

Every function works on the concatenated UTF-8 bytes of a run of documents,
so a task never loops over words in Python.  A slice holds a few MB of text;
a longer single text stands alone (about 40 bytes of memory per text byte).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
NULL_ID = -(2 ** 63)   # a null doc_id sorts before every other id
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2 ** 64)


def give_back() -> None:
    """Freed memory goes back to the system: a reused worker would keep it beside the JVM's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_slices(batches, size: int = SLICE_BYTES) -> Iterator[tuple]:
    """(batch rows, offsets, bytes) of runs of rows; a null ``text`` is empty, a binary one a zstd frame."""
    import zstandard

    unpress = zstandard.ZstdDecompressor().decompress
    # a few hundred frames at a time: their texts are whole in memory
    parts = (p for b in batches for p in ([b.slice(k, 500) for k in range(0, len(b), 500)] if pa.types.is_binary(b.schema.field("text").type) else [b]))
    for batch in parts:
        col = batch.column(batch.schema.get_field_index("text"))
        if pa.types.is_binary(col.type):
            col = pa.array([unpress(x) for x in col.to_pylist()], pa.large_binary())
        col = col.cast(pa.large_binary()).fill_null(b"")
        bufs = col.buffers()
        n = len(col)
        if n == 0:
            continue
        offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + n + 1]
        data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
            to = min(to, n)
            yield batch.slice(at, to - at), offs[at:to + 1] - offs[at], data[offs[at]:offs[to]]
            at = to
        del batch, col, bufs, offs, data
        give_back()


def ids(batch, column: str = "doc_id") -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.int64())
    return col.fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def separator_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: The whitespace bytes between words, and the bytes between lower-cased alphanumeric words.
SPACE = separator_table(b"\x20\x09\x0a\x0b\x0c\x0d")
NOT_ALNUM = separator_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray):
    """Starts and ends of the words, and the first word of each row (n + 1)."""
    if len(data) == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offs), np.int64)
    out = sep[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = True
    before[1:] = out
    edge = offs[(offs < len(data))]
    before[edge] = True
    word = ~out
    starts = np.flatnonzero(word & before[:-1])
    before[1:] = False
    before[0] = False
    before[1:-1] = out[1:]
    before[-1] = True
    before[edge] = True
    ends = np.flatnonzero(word & before[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out, out=out)


_SPLIT = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, in place."""
    t = h >> np.uint64(33)
    h ^= t
    h *= _SPLIT[0]
    np.right_shift(h, np.uint64(33), out=t)
    h ^= t
    h *= _SPLIT[1]
    np.right_shift(h, np.uint64(33), out=t)
    h ^= t
    return h


def byte_codes() -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE))


class Rolling:
    """Polynomial hashes of any range of a sequence, from prefix sums modulo 2 ** 64."""

    def __init__(self):
        self.up = powers(1 << 16, BASE)
        self.down = powers(1 << 16, INVERSE)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            n += n // 8
            self.up, self.down = powers(n, BASE), powers(n, INVERSE)

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        self._grow(len(codes))
        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.up[:len(codes)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = prefix[ends] - prefix[starts]
        h *= self.down[starts]
        return mix(h)

    def at(self, prefix: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ranges of ``size`` at ``starts``."""
        return self.ranges(prefix, starts, starts + size)


def word_codes(roll: Rolling, table: np.ndarray, data, starts, ends) -> np.ndarray:
    """A 64-bit hash of each word."""
    return roll.ranges(roll.prefix(table[data]), starts, ends)


def ranges_to_index(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + count)."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    starts, counts = starts[keep], counts[keep]
    first = np.cumsum(counts) - counts
    out[first] = starts
    out[first[1:]] -= starts[:-1] + counts[:-1] - 1
    return np.cumsum(out)


def covered(hit: np.ndarray, size: int) -> np.ndarray:
    """Positions inside [p, p + size) of a hit p; hit and the result are flags of one length."""
    n = len(hit)
    step = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(hit)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + size, n), -1)
    return np.cumsum(step[:-1]) > 0


def binary_column(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())
