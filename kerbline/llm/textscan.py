"""Array scans over Arrow text columns: words, hashes, shingles.

All functions work on slices of a batch: the UTF-8 bytes of some whole rows, one after the
other, and the offset of each row. A slice has about ``SLICE`` bytes, or one row if that row is
longer, so memory is bounded by the longest text.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def small_batches(spark) -> None:
    """Have Spark hand texts to Python tasks in batches of at most 4 MB (or one row)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; at a task's end its worker, which Spark keeps for later tasks,
    hands the freed memory back to the system. Arrow shares the system's allocator for that."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        yield from run(batches)
        _POWERS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:  # only the GNU library has it
            trim(0)

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of successive groups of rows; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offs, offs[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, raw[offs[first] : offs[last]], offs[first : last + 1] - offs[first]
        first = last


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-row counts of the words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offs) - 1, np.int64)
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    after_gap = np.empty(len(data), dtype=bool)
    after_gap[0] = True
    after_gap[1:] = gap[:-1]
    starts = np.flatnonzero(~gap & (after_gap | edge[:-1]))
    before_gap = np.empty(len(data), dtype=bool)
    before_gap[-1] = True
    before_gap[:-1] = gap[1:]
    ends = np.flatnonzero(~gap & (before_gap | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offs))
    return starts, ends, counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running polynomial sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a row, and how many each row has.

    A row with fewer than ``k`` words has one shingle, its whole sequence; a row without words
    has none.
    """
    short = (counts > 0) & (counts < k)
    per_row = np.where(counts >= k, counts - k + 1, short.astype(np.int64))
    first = np.concatenate(([0], np.cumsum(counts)))
    out_first = np.concatenate(([0], np.cumsum(per_row)))
    out = np.empty(out_first[-1], dtype=np.uint64)
    if len(hashes) >= k:
        run = np.full(len(hashes) - k + 1, k, dtype=np.uint64)
        for j in range(k):
            run = run * np.uint64(_BASE) + hashes[j : len(hashes) - k + 1 + j]
        run = mix(run)
        full = np.flatnonzero(counts >= k)
        inside = np.repeat(first[full] - out_first[full], per_row[full])
        where = np.flatnonzero(np.repeat(~short, per_row))
        out[where] = run[where + inside]
    for row in np.flatnonzero(short):
        value = np.array([counts[row]], dtype=np.uint64)
        for h in hashes[first[row] : first[row + 1]]:
            value = value * np.uint64(_BASE) + h
        out[out_first[row]] = mix(value)[0]
    return out, per_row


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and per-row counts."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)
