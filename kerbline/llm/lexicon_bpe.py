"""Byte-level BPE through a minimal acyclic transducer of frequent spans."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.spans import SpanTable
from kerbline.llm.textscan import lists, slices, span_hashes, trimmed, words
from kerbline.session import ensure_checkpoint_dir

LONGEST = 48


def spaced_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of white space with the word after it, and white space at a row's end; counts by row."""
    starts, ends, counts = words(data, offs)
    rows = np.repeat(np.arange(len(counts)), counts)
    begin = offs[:-1][rows]
    if len(starts) > 1:
        same = rows[1:] == rows[:-1]
        begin[1:][same] = ends[:-1][same]
    last = np.cumsum(counts) - 1
    stop = np.where(counts > 0, ends[np.maximum(last, 0)] if len(ends) else 0, offs[:-1])
    tail = np.flatnonzero(stop < offs[1:])
    if len(tail):
        at = np.cumsum(counts)[tail]
        begin, ends = np.insert(begin, at, stop[tail]), np.insert(ends, at, offs[1:][tail])
        counts = counts.copy()
        counts[tail] += 1
    return begin, ends, counts


def count_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(span binary, n): how often each span of at most ``LONGEST`` bytes occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[int, int] = {}
        spans: list[bytes] = []
        totals = np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(spans, pa.binary()), pa.array(totals[: len(spans)])], names=["span", "n"])

        for batch in batches:
            for _, data, offs in slices(batch.column(0)):
                starts, ends, _ = spaced_spans(data, offs)
                fits = ends - starts <= LONGEST
                starts, ends = starts[fits], ends[fits]
                keys, at, n = np.unique(span_hashes(data, starts, ends), return_index=True, return_counts=True)
                slot = np.empty(len(keys), np.int64)
                for i, (name, a) in enumerate(zip(keys.tolist(), at.tolist(), strict=True)):
                    j = index.get(name)
                    if j is None:
                        j = index[name] = len(spans)
                        spans.append(data[starts[a] : ends[a]].tobytes())
                    slot[i] = j
                totals = np.concatenate((totals, np.zeros(max(0, len(spans) - len(totals)), np.int64)))
                totals[slot] += n
                if len(spans) > 300_000:
                    yield out()
                    index, spans, totals = {}, [], np.zeros(0, np.int64)
        if spans:
            yield out()

    return docs.select(text).mapInArrow(trimmed(run), "span binary, n long").groupBy("span").agg(F.sum("n").alias("n"))


def compile_transducer(entries: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the minimal acyclic automaton of the keys; the sum of ``skip`` along a key's
    path is its rank, which finds its ids.

    Keys are added in order; a state is frozen, and shared with an equal one, as soon as no
    later key can pass through it.
    """
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []
    finals = [False]
    edges: list[dict[int, int]] = [{}]
    labels: list[int] = []

    def freeze(depth: int) -> None:
        while len(edges) - 1 > depth:
            kept, final = edges.pop(), finals.pop()
            key = (final, tuple(sorted(kept.items())))
            state = register.get(key)
            if state is None:
                state = register[key] = len(frozen)
                frozen.append((final, key[1], int(final) + sum(frozen[t][2] for _, t in key[1])))
            edges[-1][labels.pop()] = state

    previous = b""
    for word in sorted(entries):
        shared = 0
        while shared < min(len(word), len(previous)) and word[shared] == previous[shared]:
            shared += 1
        freeze(shared)
        for byte in word[shared:]:
            labels.append(byte)
            edges.append({})
            finals.append(False)
        finals[-1] = True
        previous = word
    freeze(0)
    frozen.append((finals[0], tuple(sorted(edges[0].items())), 0))
    used = sorted({b for _, out, _ in frozen for b, _ in out})
    column = np.zeros(256, np.int16)
    column[used] = np.arange(1, len(used) + 1)
    step = np.full((len(frozen) + 1, len(used) + 1), len(frozen), np.int32)
    skip = np.zeros(step.shape, np.int32)
    final = np.zeros(len(frozen) + 1, bool)
    for state, (ends_here, out, _) in enumerate(frozen):
        final[state] = ends_here
        passed = int(ends_here)
        for byte, target in out:
            step[state, column[byte]], skip[state, column[byte]] = target, passed
            passed += frozen[target][2]
    ids = [entries[w] for w in sorted(entries)]
    counts = np.array([len(x) for x in ids] or [0], np.int64)
    return {
        "column": column, "step": step, "skip": skip, "final": final, "root": np.array([len(frozen) - 1]),
        "first": np.cumsum(counts) - counts, "count": counts, "ids": np.array([i for x in ids for i in x], np.int32),
    }


class LexiconTable(SpanTable):
    """Spans in the transducer are read off it; the others are merged by the tokenizer itself."""

    def __init__(self, tokenizer_json: str, arrays: dict[str, np.ndarray]):
        super().__init__(tokenizer_json)
        self.a = arrays

    def known(self, data, starts, ends):
        a = self.a
        dead = len(a["step"]) - 1
        state = np.full(len(starts), a["root"][0], np.int64)
        rank = np.zeros(len(starts), np.int64)
        length = ends - starts
        live = np.flatnonzero(length <= LONGEST)
        state[length > LONGEST] = dead
        for depth in range(LONGEST):
            live = live[(length[live] > depth) & (state[live] != dead)]
            if not len(live):
                break
            column = a["column"][data[starts[live] + depth]]
            rank[live] += a["skip"][state[live], column]
            state[live] = a["step"][state[live], column]
        found = a["final"][state]
        first, count = np.zeros(len(starts), np.int64), np.full(len(starts), -1, np.int64)
        first[found], count[found] = a["first"][rank[found]], a["count"][rank[found]]
        return first, count, a["ids"]


def _publish(spark: SparkSession, arrays: dict[str, np.ndarray]) -> tuple[str, dict[str, tuple[int, str, tuple]]]:
    """Write the arrays as one file in the shared folder and have Spark hand it to every executor.

    Returns the file's name and each array's (offset, type, shape), for memory maps.
    """
    ensure_checkpoint_dir(spark)
    out, layout = io.BytesIO(), {}
    for name, x in arrays.items():
        out.write(b"\0" * (-out.tell() % 64))
        layout[name] = (out.tell(), x.dtype.str, x.shape)
        out.write(np.ascontiguousarray(x).tobytes())
    file = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{file}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).create(target)
    stream.write(bytearray(out.getvalue()))
    stream.close()
    spark.sparkContext.addFile(path)
    return file, layout


def _mapped(file: str, layout: dict[str, tuple[int, str, tuple]]) -> dict[str, np.ndarray]:
    path = SparkFiles.get(file)
    return {k: np.memmap(path, dtype=d, mode="r", offset=o, shape=s) if np.prod(s) else np.zeros(s, d) for k, (o, d, s) in layout.items()}


def encode(docs: DataFrame, tokenizer: str, lexicon_size: int = 32_768, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids array<int>`` of every whole text, equal to the tokenizer's own ids.

    Spans (white space and the word after it) of all texts are counted; the ``lexicon_size``
    most frequent ones and their ids become a minimal acyclic transducer, whose size depends on
    that parameter only. Executors map it into memory. Other spans are merged by the tokenizer,
    once per task each. A null text is empty and gives no ids; rows and ids may repeat or be
    null; an empty table gives no rows; other columns are ignored.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    source = Path(tokenizer).read_text(encoding="utf-8")
    own = Tokenizer.from_str(source)
    top = count_spans(docs, text).orderBy(F.desc("n"), "span").limit(lexicon_size).collect()  # lexicon_size short rows
    spans = [bytes(r["span"]) for r in top]
    found = own.encode_batch_fast([s.decode("utf-8", "replace") for s in spans], add_special_tokens=False)
    file, layout = _publish(spark, compile_transducer({s: x.ids for s, x in zip(spans, found, strict=True)}))
    shared = spark.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = LexiconTable(shared.value, _mapped(file, layout))
        for batch in batches:
            for first, data, offs in slices(batch.column(1)):
                starts, ends, counts = spaced_spans(data, offs)
                ids, per_span = table.encode(data, starts, ends, span_hashes(data, starts, ends))
                edge = np.concatenate(([0], np.cumsum(per_span)))[np.concatenate(([0], np.cumsum(counts)))]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(offs) - 1), lists(ids, np.diff(edge), pa.int32()),
                ], names=["key", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text)
    return rows.mapInArrow(trimmed(run), "key long, ids array<int>").withColumnRenamed("key", key)


def token_bytes(tokenizer_json: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer.

    The vocabulary writes each byte as one printable character: printable bytes as themselves,
    the others, in order, as the characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    spec = json.loads(tokenizer_json)
    out: dict[int, bytes] = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    out |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """``encoded`` (``key, ids``) with the text of the ids as ``decoded``; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = np.array(token_bytes(shared.value), dtype=object)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [b"".join(pieces[x.values.to_numpy(zero_copy_only=False)]).decode("utf-8", "replace") if x.is_valid else "" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["key", "ids", "decoded"])

    rows = encoded.select(F.col(key).alias("key"), "ids")
    return rows.mapInArrow(trimmed(run), "key long, ids array<int>, decoded string").withColumnRenamed("key", key)
