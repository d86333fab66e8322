"""Scan descriptors and loop candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kerbline.functions.labels import ring_of, sector_of
from kerbline.operators.windows import group_codes, top_k


def scan_descriptor(points: DataFrame, scan: list[str], rings: int = 20, sectors: int = 60,
                    max_radius: float = 80.0) -> DataFrame:
    """Greatest height per ring and sector, not below 0, as ARRAY<ARRAY<DOUBLE>>.

    The point data is reduced to at most ``rings * sectors`` rows per scan before the dense
    array is built.
    """
    cells = points.withColumn("__r", ring_of("x", "y", max_radius, rings)).withColumn(
        "__c", F.col("__r") * sectors + sector_of("x", "y", sectors)
    )
    # a scan with no point in reach still gets its all-zero descriptor
    tops = cells.groupBy(*scan, "__c").agg(F.greatest(F.max("z"), F.lit(0.0)).cast("double").alias("__z"))
    entries = F.collect_list(F.when(F.col("__c").isNotNull(), F.struct("__c", "__z")))
    packed = tops.groupBy(*scan).agg(F.map_from_entries(entries).alias("__m"))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(rings - 1)),
        lambda r: F.transform(
            F.sequence(F.lit(0), F.lit(sectors - 1)),
            lambda s: F.coalesce(F.col("__m")[(r * sectors + s).cast("long")], F.lit(0.0)),
        ),
    )
    return packed.select(*scan, dense.alias("descriptor"))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v) / F.size(values)


def ring_key(descriptor: str | Column) -> Column:
    """Mean height per ring."""
    return F.transform(descriptor, _mean)


def _cells(column: pa.Array) -> np.ndarray:
    """The descriptors of a batch as one array (rows, rings, sectors)."""
    rings = len(column[0]) if len(column) else 0
    flat = column.flatten().flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), rings, -1) if rings else np.zeros((len(column), 0, 0))


@F.arrow_udf(DoubleType())
def descriptor_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Least distance over all sector shifts, divided by the number of cells.

    ``|a - shift(b)|^2 = |a|^2 + |b|^2 - 2 a.shift(b)``. The products with all shifts are a
    circular correlation along the sectors, summed over the rings, so a whole batch takes a few
    Fourier transforms. All descriptors of a batch have one shape; a null one gives null.
    """
    both = np.asarray(a.is_valid()) & np.asarray(b.is_valid())
    keep = pa.array(both)
    x, y = _cells(a.filter(keep)), _cells(b.filter(keep))
    out = np.full(len(both), np.nan)
    if x.size:
        spectrum = (np.fft.rfft(x, axis=2) * np.conj(np.fft.rfft(y, axis=2))).sum(axis=1)
        best = np.fft.irfft(spectrum, n=x.shape[2], axis=1).max(axis=1)
        gap = (x * x).sum(axis=(1, 2)) + (y * y).sum(axis=(1, 2)) - 2 * best
        # what is left of equal descriptors is rounding
        gap[gap < 1e-12 * ((x * x).sum(axis=(1, 2)) + (y * y).sum(axis=(1, 2)))] = 0.0
        out[both] = np.sqrt(np.maximum(gap, 0.0)) / (x.shape[1] * x.shape[2])
    return pa.array(out, pa.float64(), mask=~both)


def _projections(key: str, size: int) -> list[Column]:
    """Three orthonormal views of a ring key: no view differs by more than the L2 distance."""
    signs = [
        [1.0] * size,
        [1.0 if i < size // 2 else -1.0 for i in range(size)],
        [1.0 if (4 * i // size) % 2 == 0 else -1.0 for i in range(size)],
    ]
    out = []
    for row in signs:
        terms = [F.col(key)[i] * (s / size**0.5) for i, s in enumerate(row)]
        out.append(sum(terms[1:], terms[0]))
    return out


#: Keyframes and candidates compared at once, candidates of a part as a multiple of its keyframes.
ROWS, COLUMNS, MORE = 512, 4096, 10


def _nearest(keys: np.ndarray, idx: np.ndarray, others: np.ndarray, other_idx: np.ndarray, separation: int,
             threshold: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, candidate and distance of the ``k`` nearest candidates of every row; candidates are sorted by index.

    Products of whole blocks tell which candidates can be among them, with room for rounding; the
    distance of those is then worked out term by term. Each block lowers the bound for the next.
    """
    middle = keys.mean(axis=0)
    a, b = keys - middle, others - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    slack = 1e-12 * (aa.max(initial=0.0) + bb.max(initial=0.0))
    found = []
    for s in range(0, len(a), ROWS):
        rows = np.arange(s, min(s + ROWS, len(a)))
        limit = np.searchsorted(other_idx, idx[rows] - separation, "right")
        bound = np.full(len(rows), threshold * threshold * (1 + 1e-12))
        r, c, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for t in range(0, int(limit.max()), COLUMNS):
            columns = np.arange(t, min(t + COLUMNS, int(limit.max())))
            gap = a[rows] @ b[columns].T
            gap *= -2
            gap += aa[rows][:, None]
            gap += bb[columns]
            if columns[-1] >= limit.min():
                gap[columns >= limit[:, None]] = np.inf
            near = gap <= (bound + slack)[:, None]
            if len(columns) > k and near.sum() > 4 * k * len(rows):
                bound = np.minimum(bound, np.partition(gap, k - 1, axis=1)[:, k - 1] + slack)
                near = gap <= (bound + slack)[:, None]
            x, y = np.nonzero(near)
            total = np.zeros(len(x))
            for i in range(keys.shape[1]):
                total += (keys[rows[x], i] - others[columns[y], i]) ** 2
            total = np.sqrt(total)
            close = total < threshold
            r, c, d = np.append(r, x[close]), np.append(c, columns[y[close]]), np.append(d, total[close])
            order = np.lexsort((c, d, r))
            counts = np.bincount(r, minlength=len(rows))
            begin = np.cumsum(counts) - counts
            order = order[np.arange(len(order)) - np.repeat(begin, counts) < k]
            r, c, d = r[order], c[order], d[order]
            counts = np.minimum(counts, k)
            full = np.flatnonzero(counts == k)
            bound[full] = np.minimum(bound[full], d[(np.cumsum(counts) - 1)[full]] ** 2 * (1 + 1e-12))
        found.append((rows[r], c, d))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _whole_keys(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of sorted input that never cut the rows of a key."""
    key = lambda batch, i: [batch.column(c)[i].as_py() for c in by]
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and key(held[-1], -1) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        edges = np.flatnonzero(np.diff(group_codes([batch.column(c) for c in by])[0])) + 1
        if len(edges):
            held.append(batch.slice(0, edges[-1]))
            yield pa.Table.from_batches(held)
            held = [batch.slice(edges[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def loop_candidates(keyframes: DataFrame, ring_size: int, separation: int = 100, threshold: float = 0.5,
                    k: int = 10, by: list[str] | None = None, hot_rows: int = 20_000) -> DataFrame:
    """For each keyframe the ``k`` nearest earlier ones by ring key.

    A pair closer than ``threshold`` differs by less than ``threshold`` in each projection,
    so candidates are copied to the neighbouring cells and meet the keyframes of a cell there; the
    distance is checked last. Only the ``k`` earliest of identical ring keys can be among a
    keyframe's best (equal distance, lower index first, and the separation test favours
    early ones), so copies beyond that are left out of the candidate side without changing
    the result. A cell is cut into parts of about ``hot_rows`` keyframes and ``MORE`` times as many candidates,
    of which every two meet; a part is compared by products of blocks (:func:`_nearest`).
    """
    by = by or []
    views = _projections("ring_key", ring_size)
    cells = ["__c0", "__c1", "__c2"]
    keys = [*by, *cells]
    base = keyframes.select(*by, "idx", "ring_key")
    for name, view in zip(cells, views):
        base = base.withColumn(name, F.floor(view / threshold))
    base = base.dropna(subset=["idx", *keys])
    few = top_k(base, [*by, "ring_key"], [F.asc("idx")], k).drop("rank")
    around = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])

    def spread(rows: DataFrame) -> DataFrame:
        for name in cells:
            rows = rows.withColumn("__o", F.explode(around)).withColumn(name, F.col(name) + F.col("__o")).drop("__o")
        return rows

    def parts(counts: DataFrame, most: int, name: str) -> DataFrame:
        return F.broadcast(counts.select(*keys, F.ceil(F.col("__n") / most).cast("long").alias(name)).filter(F.col(name) > 1))

    mine = parts(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), hot_rows, "__mine")
    copied = spread(few.groupBy(*keys).agg(F.count(F.lit(1)).alias("__m"))).groupBy(*keys).agg(F.sum("__m").alias("__n"))
    theirs = parts(copied, MORE * hot_rows, "__theirs")
    first, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    key = F.slice("ring_key", 1, ring_size).cast("array<double>").alias("__key")

    def dealt(rows: DataFrame, side: int, own: str, other: str) -> DataFrame:
        cut = rows.join(mine, keys, "left").join(theirs, keys, "left")
        place = F.pmod(F.xxhash64("idx", "ring_key"), F.coalesce(own, one)).alias(own)
        every = F.explode(F.sequence(first, F.coalesce(other, one) - 1)).alias(other)
        return cut.select(*keys, place, every, F.lit(side).alias("__side"), "idx", key).select(*keys, "__mine", "__theirs", "__side", "idx", "__key")

    group = [*keys, "__mine", "__theirs"]
    both = dealt(base, 1, "__mine", "__theirs").unionByName(dealt(spread(few), 0, "__theirs", "__mine"))
    # a number of partitions, as few bytes are much work here
    spark = keyframes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sorted_rows = both.repartition(tasks, *group).sortWithinPartitions(*group, "__side", "idx")
    kind = keyframes.schema["idx"].dataType
    schema = StructType([*[keyframes.schema[c] for c in by], StructField("idx", kind), StructField("cand_idx", kind), StructField("ring_dist", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, group):
            table = table.combine_chunks()
            code = group_codes([c.combine_chunks() for c in (table.column(n) for n in group)])[0]
            edges = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
            side, idx = table.column("__side").to_numpy(), table.column("idx").to_numpy()
            values = pc.list_flatten(table.column("__key").combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, ring_size)
            finite = np.isfinite(values).all(axis=1)
            for start, stop in zip(edges, edges[1:], strict=False):
                there = start + np.flatnonzero(finite[start:stop])
                a, b = there[side[there] == 1], there[side[there] == 0]
                if not len(a) or not len(b) or idx[a[-1]] - idx[b[0]] < separation:
                    continue
                r, c, d = _nearest(values[a], idx[a], values[b], idx[b], separation, threshold, k)
                of = pa.array(a[r])
                yield pa.RecordBatch.from_arrays([*[table.column(n).combine_chunks().take(of) for n in by], pa.array(idx[a[r]]), pa.array(idx[b[c]]), pa.array(d)],
                                                 names=[*by, "idx", "cand_idx", "ring_dist"])

    close = sorted_rows.mapInArrow(run, schema)
    return top_k(close, [*by, "idx"], [F.asc("ring_dist"), F.asc("cand_idx")], k)


def detect_loops(keyframes: DataFrame, candidates: DataFrame, max_distance: float,
                 by: list[str] | None = None) -> DataFrame:
    """Best candidate per keyframe by descriptor distance, if it is close enough."""
    by = by or []
    mine = keyframes.select(*by, "idx", F.col("descriptor").alias("__a"))
    other = keyframes.select(*by, F.col("idx").alias("cand_idx"), F.col("descriptor").alias("__b"))
    scored = candidates.join(mine, [*by, "idx"]).join(other, [*by, "cand_idx"]).withColumn(
        "distance", descriptor_distance("__a", "__b")
    )
    near = scored.filter(F.col("distance") < max_distance)
    best = top_k(near, [*by, "idx"], [F.asc("distance"), F.asc("cand_idx")], 1)
    return best.select(*by, "idx", F.col("cand_idx").alias("match_idx"), "distance")
