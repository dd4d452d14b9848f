"""Words, word hashes and shingles of many texts at once, with numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Texts are handled as the UTF-8 bytes
of an Arrow column: no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute

#: Bytes of text handled at a time inside a task; one longer text is handled by itself.
CHUNK_BYTES = 4 << 20
#: The same where every word of the texts becomes an object.
OBJECT_BYTES = 1 << 20
#: Bytes of words that are hashed at a time.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTES = np.random.default_rng(20_240_131).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def chunks(batch: pa.RecordBatch, column: str = "text", each: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``each`` bytes of text."""
    sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64)
    upto = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        limit = (upto[at - 1] if at else 0) + each
        end = max(at + 1, int(np.searchsorted(upto, limit, "right")))
        yield batch.slice(at, end - at)
        at = end
    release()


def release() -> None:
    """Freed memory goes back to the system. What Arrow and the C library hold on to would add
    up over the stages that one worker runs."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow; a worker that has ended it holds none of its memory."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]):
    """``run`` for applyInArrow; a worker that has ended it holds its result alone."""

    @wraps(run)
    def tidied(table: pa.Table) -> pa.Table:
        out = run(table)
        release()
        return out

    return tidied


class Words:
    """Word bounds of a column of texts: bytes ``data[starts[i]:ends[i]]`` are word i, and
    words ``first[d]`` up to ``first[d + 1]`` are text d. A null text has none."""

    def __init__(self, column: pa.Array):
        column = pa.compute.fill_null(column, "").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        buffer = column.buffers()[2]
        self.data = np.frombuffer(buffer, np.uint8)[low:high] if buffer is not None else np.zeros(0, np.uint8)
        offsets = offsets - low
        n = len(self.data)
        space = _SPACE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64 bits for each word, from its bytes alone. Words are taken some at a time, and one
        longer word in pieces, so that what this needs beside its result is bounded."""
        out = np.empty(len(self.starts), np.uint64)
        table = _BYTES[_LOWER] if lower else _BYTES
        at = 0
        while at < len(out):
            end = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + SLICE_BYTES, "right")))
            out[at:end] = self._sums(at, end, table)
            at = end
        return mixed(out + (self.ends - self.starts).astype(np.uint64) * _STEP)

    def _sums(self, at: int, end: int, table: np.ndarray) -> np.ndarray:
        """Sum of each word's bytes times powers of their places."""
        low, high = int(self.starts[at]), int(self.ends[end - 1])
        if high - low > SLICE_BYTES:  # one long word
            total, factor = np.uint64(0), np.uint64(1)
            step = powers(SLICE_BYTES + 1)
            with np.errstate(over="ignore"):  # arithmetic modulo 2^64
                for piece in range(low, high, SLICE_BYTES):
                    data = self.data[piece : min(piece + SLICE_BYTES, high)]
                    total += (table[data] * step[: len(data)]).sum(dtype=np.uint64) * factor
                    factor *= step[SLICE_BYTES]
            return np.array([total])
        starts, lengths = self.starts[at:end] - low, (self.ends - self.starts)[at:end]
        # Each byte's place since the last word began.
        place = np.arange(high - low) - np.repeat(starts, np.diff(np.append(starts, high - low)))
        parts = table[self.data[low:high]] * powers(int(lengths.max()) + 1)[np.minimum(place, lengths.max())]
        parts[_SPACE[self.data[low:high]]] = 0
        return np.add.reduceat(parts, starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words; of a shorter text, one for the whole of it."""
    n = len(hashes)
    if not n:
        return _NONE
    width = min(width, n)
    total = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        total = mixed(total + hashes[j : n - width + 1 + j])
    return total
