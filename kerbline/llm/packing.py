"""Best-fit packing in a hierarchy: local rounds, then underfull bins as items of the next."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.spans import SpanTable
from kerbline.llm.textscan import slices, span_hashes, trimmed, words
from kerbline.session import settle

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset there, and each bin's fill.

    Open bins are kept by free space; a bit mask of the spaces in use finds the tightest.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    for item in order.tolist():
        size = int(sizes[item])
        fits = mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            at = open_bins[space].pop()
            if not open_bins[space]:
                mask &= ~(1 << space)
        else:
            at, space = len(fill), capacity
            fill.append(0)
        bins[item], offsets[item] = at, fill[at]
        fill[at] += size
        left = space - size
        if left:
            open_bins[left].append(at)
            mask |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def _local(docs: DataFrame, key: str, text: str, tokenizer_json: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of all documents with their bin and place in the bins of their task."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = SpanTable(shared.value)
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            keys = batch.column(0)
            for first, data, offs in slices(batch.column(1)):
                starts, ends, counts = words(data, offs)
                ids, per_word = table.encode(data, starts, ends, span_hashes(data, starts, ends))
                word_edge = np.concatenate(([0], np.cumsum(per_word)))
                row_edge = word_edge[np.concatenate(([0], np.cumsum(counts)))]
                rows: list[tuple[int, int, int, int, int]] = []
                for row in range(len(offs) - 1):
                    own = np.append(ids[row_edge[row] : row_edge[row + 1]], end_id).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        rows.append((first + row, piece, start, len(cut), zlib.crc32(cut)))
                table_rows = np.array(rows, np.int64)
                parts.append((keys.take(pa.array(table_rows[:, 0])), *table_rows[:, 1:].T))
        if not parts:
            return
        length = np.concatenate([p[3] for p in parts])
        bins, places, _ = best_fit(length, capacity)
        bins += TaskContext.get().partitionId() << 36
        done = 0
        for part in parts:
            n = len(part[0])
            yield pa.RecordBatch.from_arrays([
                part[0].cast(pa.int64()), pa.array(part[1].astype(np.int32)), *(pa.array(x) for x in part[2:]),
                pa.array(bins[done : done + n]), pa.array(places[done : done + n]),
            ], names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "place"])
            done += n

    return docs.select(F.col(key).cast("long").alias(key), F.col(text)).mapInArrow(trimmed(run), PIECES)


def _merge(items: DataFrame, tasks: int, capacity: int) -> DataFrame:
    """One round over underfull bins: (bin, into, shift, fill of into)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        names, sizes = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.argsort(names)
        names, sizes = names[order], sizes[order]
        bins, shift, fill = best_fit(sizes, capacity)
        lead = np.zeros(len(fill), np.int64)
        lead[bins[shift == 0]] = names[shift == 0]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names, lead[bins], shift, fill[bins])], names=["bin", "into", "shift", "fill"])

    return items.select("bin", "fill").repartition(tasks, "bin").mapInArrow(trimmed(run), "bin long, into long, shift long, fill long")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, nearly_full: float = 0.995,
    per_task: int = 100_000, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents packed into sequences of at most ``capacity`` tokens.

    A document is its token ids and then ``end_id``; only longer ones are cut. Each task packs
    its own pieces by best fit. Bins filled to ``nearly_full`` are final; the others become
    items of a next round, which merges the items of several tasks: at first about ``per_task``
    to a task, then half as many tasks each round, until one task sees all that are left. Bins
    too full for the emptiest one are final too. Items are two numbers each; texts are read
    once and never shuffled.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null or empty
    text is ``end_id`` alone. Rows that repeat an id are packed on their own; a null id stays
    null. An empty table gives no rows; other columns are ignored.
    """
    pieces = settle(_local(docs, key, text, Path(tokenizer).read_text(encoding="utf-8"), capacity, end_id))
    items = pieces.groupBy("bin").agg(F.sum("length").alias("fill")).where(F.col("fill") < nearly_full * capacity)
    items = settle(items)
    moved = items.select("bin", F.col("bin").alias("sequence_id"), F.lit(0).cast("long").alias("shift"))
    before = items.count()
    tasks = -(-before // per_task)
    while before > 1:
        step = settle(_merge(items, tasks, capacity))
        hop = step.select(F.col("bin").alias("sequence_id"), "into", F.col("shift").alias("more"))
        moved = settle(
            moved.join(hop, "sequence_id", "left")
            .select("bin", F.coalesce("into", "sequence_id").alias("sequence_id"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        )
        if tasks == 1:
            break
        left = settle(step.where((F.col("shift") == 0) & (F.col("fill") < nearly_full * capacity)).select("bin", "fill"))
        least = left.agg(F.min("fill")).first()[0]
        items = left.where(F.col("fill") <= capacity - (least or 0))
        before = items.count()
        tasks = min(-(-tasks // 2), -(-before // per_task))
    out = pieces.join(moved, "bin", "left")
    return out.select(
        F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
