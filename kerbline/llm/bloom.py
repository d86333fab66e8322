"""A bitmap of fixed size for 64-bit hashes, filled and merged by Spark tasks.

The size is at most ``MAX_BITS`` whatever the input, so the bitmap may be broadcast. A full
bitmap only answers "maybe" more often; every user treats "maybe" as a hint that an exact step
settles, so the size never changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.llm.textscan import mix, trimmed

MAX_BITS = 1 << 26
SLICE_BITS = 1 << 16


def size_for(rows: int) -> int:
    """Bits for so many hashes: 16 each, a power of two, at most ``MAX_BITS``."""
    bits = SLICE_BITS
    while bits < 16 * rows and bits < MAX_BITS:
        bits *= 2
    return bits


def _places(values: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(values.view(np.uint64))
    return [(h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]


def _as_bits(packed: bytes | None) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)


def build(df: DataFrame, column: str, bits: int, twice: bool = False) -> np.ndarray:
    """The bitmap of all values of a long column; with ``twice``, of those seen at least twice.

    Each task fills its own bitmap and sends the slices that are not empty; slices are merged
    by key, so no task holds more than the bitmap. The driver receives one merged bitmap.
    With ``twice`` a value counts as repeated when all its bits were set before, in its own
    task or in another one.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, np.uint8)  # 0: never, 1: once, 2: again
        for batch in batches:
            for at in range(0, batch.num_rows, 100_000):
                values = batch.column(0).slice(at, 100_000).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                values, counts = np.unique(values, return_counts=True)
                for place in _places(values, bits):
                    if twice:
                        # two values of one batch that share a bit may be copies as far as the bit can tell
                        _, where, shared = np.unique(place, return_inverse=True, return_counts=True)
                        seen[place] = np.where((seen[place] > 0) | (counts > 1) | (shared[where] > 1), 2, 1)
                    else:
                        seen[place] = 1
        parts = seen.reshape(-1, SLICE_BITS)
        for i in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([
                pa.array([i], pa.int32()), pa.array([np.packbits(parts[i] > 0).tobytes()], pa.binary()), pa.array([np.packbits(parts[i] > 1).tobytes()], pa.binary()),
            ], names=["slice", "once", "again"])

    def merge(key: tuple[Any, ...], group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, again = np.zeros(SLICE_BITS, bool), np.zeros(SLICE_BITS, bool)
        for part in group:
            for a, b in zip(part["once"], part["again"], strict=True):
                a = _as_bits(a)
                again |= _as_bits(b) | (once & a)
                once |= a
        yield pd.DataFrame({"slice": [key[0]], "bits": [np.packbits(again if twice else once).tobytes()]})

    merged = (
        df.select(column).mapInArrow(trimmed(fill), "slice int, once binary, again binary")
        .groupBy("slice").applyInPandas(merge, "slice int, bits binary")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # at most bits / SLICE_BITS rows, 8 MB in all
        out[row["slice"] * SLICE_BITS // 8 : (row["slice"] + 1) * SLICE_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def contains(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value may be among those that filled the packed bitmap."""
    bits = len(bitmap) * 8
    found = np.ones(len(values), bool)
    for place in _places(values.astype(np.int64), bits):
        found &= (bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return found


def drop_rows(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose long ``key`` is in the column of the same name of ``gone``.

    Rows that a bitmap of the dropped keys clears pass without a shuffle; only the others are
    joined. A null key is never dropped.
    """
    gone = gone.select(key)
    bitmap = build(gone, key, size_for(gone.count()))
    flagged = df.withColumn("__maybe", F.coalesce(maybe(df, bitmap, key), F.lit(False)))
    clear, doubtful = flagged.where("not __maybe"), flagged.where("__maybe")
    return clear.unionByName(doubtful.join(gone, key, "left_anti").select(*flagged.columns)).drop("__maybe")


def near_rows(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` joined with ``wanted`` on a long ``key``; most other rows don't reach the shuffle."""
    bitmap = build(wanted.select(key), key, size_for(wanted.count()))
    return df.where(maybe(df, bitmap, key)).join(wanted, key)


def only_rows(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose long ``key`` is in ``wanted``, which holds each key once."""
    return near_rows(df, wanted.select(key), key).select(*df.columns)


def maybe(df: DataFrame, bitmap: np.ndarray, column: str) -> Column:
    """``contains`` as a column; a null value is never contained."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        filled = values.notna()
        return pd.Series(contains(shared.value, values.fillna(0).to_numpy().astype(np.int64)), index=values.index) & filled

    return test(F.col(column))
