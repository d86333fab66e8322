"""Size-aware heavy-light Jaccard join over word shingles, to connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.bloom import build, contains, drop_rows, near_rows, size_for
from kerbline.llm.components import components, contract
from kerbline.llm.textscan import LOWER, lists, mix, shingles, signed, slices, span_hashes, trimmed, words
from kerbline.session import settle

#: Counters of the frequency sketch, and the largest set that may be enumerated.
SKETCH, SMALL = 1 << 20, 64


@dataclass(frozen=True)
class Rule:
    """Sets of ``k``-word shingles link at a Jaccard similarity of ``num / den`` or more.

    Each set carries a histogram of ``cells`` (a power of two). More cells tell larger sets
    apart without a look at the sets; lower similarities need more. They never change a result.
    """

    k: int = 3
    num: int = 9
    den: int = 10
    cells: int = 128

    def needed(self, a, b):
        """Shared shingles that sets of these sizes need."""
        return -((-self.num * (a + b)) // (self.num + self.den))

    def smallest(self, a):
        return -((-self.num * a) // self.den)

    def largest(self, a):
        return (a * self.den) // self.num

    def prefix(self, a):
        """So many elements that two linked sets share one of them, in any fixed order."""
        return a - self.needed(a, self.smallest(a)) + 1

    def subset_sizes(self, a: int, most: int) -> set[int]:
        return {self.needed(a, b) for b in range(self.smallest(a), min(self.largest(a), most) + 1)}

    def subsets(self, a: int, most: int) -> int:
        return sum(comb(a, m) for m in self.subset_sizes(a, most))


def row_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for first, data, offs in slices(column):
        data = LOWER[data]
        starts, ends, counts = words(data, offs)
        all_of, per_row = shingles(span_hashes(data, starts, ends), counts, k)
        edge = np.concatenate(([0], np.cumsum(per_row)))
        for i in range(len(per_row)):
            yield first + i, np.unique(all_of[edge[i] : edge[i + 1]])


def histogram(elements: np.ndarray, cells: int) -> np.ndarray:
    """Elements by cell, capped at 255: L1 distances never exceed the sets' difference."""
    return np.minimum(np.bincount((elements >> np.uint64(7)).astype(np.int64) & (cells - 1), minlength=cells), 255).astype(np.uint8)


def frequencies(docs: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """A sketch of how many sets have each shingle among their first ones, and sets by small size.

    Every task counts into ``SKETCH`` counters and sends the parts that are not empty; parts are
    added up by key. The driver receives one sketch, whatever the number of documents.
    """
    step = 1 << 14

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sizes = np.zeros(SKETCH, np.int32), np.zeros(step, np.int32)
        for batch in batches:
            for _, s in row_sets(batch.column(0), rule.k):
                n = len(s)
                sizes[min(n, SMALL + 1)] += 1
                if n:
                    counts[(s[: 2 * rule.prefix(n)] & np.uint64(SKETCH - 1)).astype(np.int64)] += 1
        parts = [(-1, sizes), *((i, x) for i, x in enumerate(counts.reshape(-1, step)) if x.any())]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1].tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def add(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(step, np.int64), None
        for batch in group:
            for number, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = number
                total += np.frombuffer(x, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"])

    sketch, sizes = np.zeros(SKETCH, np.int64), np.zeros(step, np.int64)
    parts = docs.mapInArrow(trimmed(run), "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary")
    for row in parts.collect():
        got = np.frombuffer(row["counts"], np.int64)
        if row["part"] < 0:
            sizes += got
        else:
            sketch[row["part"] * step : (row["part"] + 1) * step] = got
    return sketch, sizes[: SMALL + 1]


def boundary(rule: Rule, sizes: np.ndarray, list_length: float) -> int:
    """The largest size up to which enumerating subsets costs less than scanning lists."""
    best, subset_cost, list_cost = 0, 0.0, 0.0
    for a in range(1, SMALL + 1):
        own = rule.subsets(a, a)
        if own > 10_000:
            break
        subset_cost += float(sizes[a]) * own
        list_cost += float(sizes[a]) * rule.prefix(a) * (1 + list_length)
        if subset_cost <= list_cost:
            best = a
    return best


def subset_keys(elements: np.ndarray, sizes: set[int]) -> np.ndarray:
    """One key for every subset of the given sizes: the sum of its elements, mixed with its size."""
    values, out = mix(elements), []
    total = values.sum(dtype=np.uint64)
    for m in sizes:
        left_out = len(elements) - m
        if left_out < 0:
            continue
        if left_out == 0:
            sums = np.array([total])
        else:
            chosen = np.array(list(combinations(range(len(elements)), left_out)))
            sums = total - values[chosen].sum(axis=1, dtype=np.uint64)
        out.append(mix(sums + np.uint64(m * 0x9E3779B97F4A7C15 % (1 << 64))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _signatures(docs: DataFrame, rule: Rule, key: str, text: str) -> DataFrame:
    """(doc_id, n, f1, f2, hist, keys) of every document.

    ``f1, f2`` are a 128-bit fingerprint of the set. ``keys`` are subset keys of small sets, and
    the first elements of large sets and of small ones that can link with them. The order of
    elements is by frequency class (frequent ones last), then hash: any fixed order finds every
    pair, this one keeps lists of shared passages short.
    """
    sketch, sizes = frequencies(docs.select(text), rule)
    often = max(64, 4 * int(sketch.sum()) // SKETCH)
    heavy = sketch >= often
    light = sketch[~heavy].astype(float)
    small = boundary(rule, sizes, (light**2).sum() / max(1.0, light.sum()))
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(heavy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = np.unpackbits(shared.value).astype(bool)
        plans: dict[int, set[int]] = {}
        for batch in batches:
            rows, out = [], []

            def emit(rows=rows, out=out, batch=batch) -> pa.RecordBatch:
                keys = [o[4] for o in out]
                flat = signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
                return pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)),
                    pa.array([o[3] for o in out], pa.binary()), lists(flat, np.array([len(x) for x in keys], np.int64), pa.int64()),
                ], names=["doc_id", "n", "f1", "f2", "hist", "keys"])

            for row, s in row_sets(batch.column(1), rule.k):
                n = len(s)
                keys = []
                if 0 < n <= small:
                    if n not in plans:
                        plans[n] = rule.subset_sizes(n, small)
                    keys.append(subset_keys(s, plans[n]))
                if n and rule.largest(n) > small:
                    rare = ~late[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                    take = rule.prefix(n)
                    first = s[rare][:take]
                    keys.append(first if len(first) == take else np.concatenate((first, s[~rare][: take - len(first)])))
                mixed = mix(s ^ np.uint64(0x5851F42D4C957F2D))
                f1, f2 = s.sum(dtype=np.uint64), mixed.sum(dtype=np.uint64)
                rows.append(row)
                out.append((n, int(f1.astype(np.int64)), int(f2.astype(np.int64)), histogram(s, rule.cells).tobytes(), np.concatenate(keys) if keys else np.zeros(0, np.uint64)))
                if len(rows) == 2000:
                    yield emit()
                    rows.clear(), out.clear()
            if rows:
                yield emit()

    return docs.select(key, text).mapInArrow(trimmed(run), "doc_id long, n long, f1 long, f2 long, hist binary, keys array<long>")


def whole_groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Tables that never cut a run of rows with equal first ``by`` columns, of sorted input."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        same_as_held = bool(held)
        for c in range(by):
            values = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
            same_as_held = same_as_held and held[-1].column(c)[-1].as_py() == values[0]
        edges = np.flatnonzero(change)
        if held and not same_as_held:
            yield pa.Table.from_batches(held)
            held = []
        if len(edges):
            held.append(batch.slice(0, edges[-1]))
            yield pa.Table.from_batches(held)
            held = [batch.slice(edges[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, by: int) -> np.ndarray:
    change = np.ones(table.num_rows, bool)
    change[1:] = False
    for c in range(by):
        values = table.column(c).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with block pairs (i, j): each group is cut into as many blocks as ``parts`` says.

    Each block meets each block in one task, so groups of any size stay whole and no task gets
    more than two blocks of one.
    """
    return (
        rows.withColumn("parts", F.coalesce("parts", F.lit(1)).cast("long"))
        .withColumn("mine", F.pmod(F.xxhash64("doc_id"), "parts"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    )


def _lists(leads: DataFrame) -> DataFrame:
    """(key, size) of the inverted lists to scan: those of two sets or more, one of each with equal members.

    Copies share nearly all their keys, so most lists hold the same sets as another one and can
    tell nothing new. Members are compared by size, xor and two sums of 64-bit marks.
    """
    marked = leads.select("mark", F.explode("keys").alias("key"))
    members = ["size", "either", "low", "high"]
    return (
        marked.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.bit_xor("mark").alias("either"),
            F.sum(F.col("mark").bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned("mark", 32)).alias("high"),
        )
        .where("size > 1").groupBy(*members).agg(F.min("key").alias("key")).select("key", "size")
    )


def _postings(leads: DataFrame, scanned: DataFrame) -> DataFrame:
    """(key, size, doc_id, n, hist): the members of the scanned lists.

    Most keys of other lists are left out before the shuffle, by a bitmap.
    """
    shared = leads.sparkSession.sparkContext.broadcast(build(scanned, "key", size_for(scanned.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3)
            ends = np.append(0, np.cumsum(keys.value_lengths().to_numpy()))
            flat = keys.flatten().to_numpy()
            found = contains(shared.value, flat)
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))[found]
            flat = flat[found]
            for at in range(0, len(flat), 20_000):
                take = pa.array(row[at : at + 20_000])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in range(3)), pa.array(flat[at : at + 20_000])], names=["doc_id", "n", "hist", "key"])

    rows = leads.select("doc_id", "n", "hist", "keys").mapInArrow(trimmed(run), "doc_id long, n long, hist binary, key long")
    return rows.join(scanned, "key")


def _candidates(postings: DataFrame, rule: Rule, per_task: int) -> DataFrame:
    """(u, v): stars of the task's links; a list gives a spanning forest of the pairs that pass the size and histogram tests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            begin = group_starts(table, 3)
            group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, table.num_rows)))
            n, doc = table["n"].to_numpy(), table["doc_id"].to_numpy()
            hist = np.frombuffer(b"".join(table["hist"].to_pylist()), np.uint8).reshape(-1, rule.cells)
            label = np.arange(len(n))
            u, v = [], []
            left = np.arange(len(n))
            portion = 4_000_000 // rule.cells
            apart = 0
            while len(left):
                apart += 1
                left = left[left + apart < len(n)]
                right = left + apart
                fits = (group[left] == group[right]) & (n[right] <= rule.largest(n[left]))
                left = left[fits]
                open_ = left[label[left] != label[left + apart]]
                for at in range(0, len(open_), portion):
                    a = open_[at : at + portion]
                    b = a + apart
                    distance = np.abs(hist[a].astype(np.int16) - hist[b]).sum(axis=1)
                    near = distance <= n[a] + n[b] - 2 * rule.needed(n[a], n[b])
                    for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
                        if label[x] != label[y]:
                            u.append(doc[x])
                            v.append(doc[y])
                            low, high = sorted((label[x], label[y]))
                            g0 = begin[group[x]]
                            g1 = begin[group[x] + 1] if group[x] + 1 < len(begin) else len(n)
                            own = label[g0:g1]
                            own[own == high] = low
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    dealt = _dealt(postings.withColumn("parts", F.ceil(F.col("size") / per_task)))
    order = ["key", "i", "j"]
    return dealt.select(*order, "n", "doc_id", "hist").repartition(*order).sortWithinPartitions(*order, "n", "doc_id").mapInArrow(trimmed(lambda b: contract(run(b))), "u long, v long")


def _verified(texts: DataFrame, rule: Rule) -> DataFrame:
    """(u, v): stars of the links that join what no link of the task has joined, from exact set overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            begin = np.append(group_starts(table, 3), table.num_rows)
            doc, mine, i, j = (table[c].to_numpy() for c in ("doc_id", "mine", "i", "j"))
            elements = [s for _, s in row_sets(table["text"], rule.k)]
            n = np.array([len(x) for x in elements])
            hist = np.stack([histogram(x, rule.cells) for x in elements])
            u, v = [], []
            for g0, g1 in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                label = np.arange(g0, g1)
                for a in range(g0, g1 - 1):
                    stop = int(np.searchsorted(n[g0:g1], rule.largest(n[a]), "right")) + g0
                    b = np.arange(a + 1, stop)
                    b = b[label[b - g0] != label[a - g0]]
                    if i[a] != j[a]:
                        b = b[mine[b] != mine[a]]
                    if not len(b):
                        continue
                    distance = np.abs(hist[b].astype(np.int16) - hist[a]).sum(axis=1)
                    b = b[distance <= n[a] + n[b] - 2 * rule.needed(n[a], n[b])]
                    for x in b.tolist():
                        if label[x - g0] == label[a - g0]:
                            continue
                        at = np.searchsorted(elements[x], elements[a])
                        at[at == n[x]] = 0
                        if (elements[x][at] == elements[a]).sum() >= rule.needed(n[a], n[x]):
                            u.append(doc[a])
                            v.append(doc[x])
                            low, high = sorted((label[x - g0], label[a - g0]))
                            label[label == high] = low
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return texts.mapInArrow(trimmed(lambda b: contract(run(b))), "u long, v long")


def jaccard_components(
    docs: DataFrame, rule: Rule = Rule(), per_list: int = 16_384, per_component: int = 2_000_000, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key, n_shingles, component_id`` per document: the classes of the Jaccard join.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; a set holds the 64-bit
    hashes of its shingles, or of the whole sequence if that is shorter than ``k`` words. Equal
    sets are one class. Small sets enumerate subsets of the size that a linked pair must share;
    large sets scan inverted lists of their first elements; the boundary comes from the costs of
    both (:func:`boundary`). Lists of more than ``per_list`` sets, and candidate components of
    more than ``per_component`` shingles, are cut into blocks of which every two meet.

    A list sends on a spanning forest of its candidate pairs, never all of them. Sets of the
    documents in a candidate component then meet once, and overlaps are counted exactly for
    every pair that is not already joined and passes bounds that no linked pair fails. So the
    components are exact, at a cost that a tight group of copies does not square.

    Documents without words (null or empty texts too) have an empty set and link with nothing.
    Rows that repeat an id are one node; a row without an id links with nothing and keeps a null
    component. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    every = settle(_signatures(rows, rule, "doc_id", "text"))
    print_of = ["f1", "f2", "n"]
    linkable = every.where("n > 0 and doc_id is not null").withColumn("mark", F.xxhash64("doc_id", *print_of))
    classes = settle(linkable.groupBy(*print_of).agg(F.min("doc_id").alias("rep")))
    # the sets with their keys stay where they are: only those that an equal set stands for go, by their mark
    copies = settle(linkable.select("doc_id", "mark", *print_of).join(classes, print_of).where("doc_id <> rep").select("mark"))
    leads = drop_rows(linkable.select("doc_id", "n", "mark", "hist", "keys"), copies, "mark")
    scanned = settle(_lists(leads))
    drafts = settle(components(_candidates(_postings(leads, scanned), rule, per_list), "u", "v", contracted=True))
    members = drafts.withColumnRenamed("node", "doc_id").join(linkable.select("doc_id", "n"), "doc_id")
    weights = members.groupBy("component").agg(F.sum("n").alias("w"))
    parts = weights.where(F.col("w") > per_component).select("component", F.ceil(F.col("w") / per_component).alias("parts"))
    order = ["component", "i", "j"]
    placed = settle(_dealt(members.join(parts, "component", "left")).select("doc_id", *order, "mine", "n"))
    # texts cross the network, not sets, which no codec can compress
    texts = near_rows(rows, placed, "doc_id").select(*order, "n", "doc_id", "mine", "text")
    joined = components(_verified(texts.repartition(*order).sortWithinPartitions(*order, "n", "doc_id"), rule), "u", "v", contracted=True)
    named = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(*print_of, F.coalesce("component", "rep").alias("c"))
    ids = every.select("doc_id", *print_of)
    with_class = ids.where("n > 0 and doc_id is not null").join(named, print_of)
    alone = ids.where("n = 0 or doc_id is null").withColumn("c", F.col("doc_id"))
    both = with_class.select("doc_id", "n", "c").unionByName(alone.select("doc_id", "n", "c"))
    return both.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))
