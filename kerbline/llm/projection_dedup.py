"""Near-equal vectors by sorted projection passes."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.components import components
from kerbline.llm.textscan import trimmed
from kerbline.session import settle


def unit_rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector at length 1 in double precision; None where it has no direction."""
    out: list[np.ndarray | None] = []
    for x in column:
        v = None if not x.is_valid else np.array([np.nan if y is None else y for y in x.as_py()], float) if x.values.null_count else x.values.to_numpy(zero_copy_only=False).astype(float)
        if v is not None:
            big = np.abs(v).max(initial=0.0)
            v = v / big if 0 < big < np.inf else None
        out.append(None if v is None or not np.isfinite(v).all() else v / np.sqrt(v @ v))
    return out


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column whose rows have one length, as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(vectors: DataFrame, passes: int, bits: int, seed: int) -> DataFrame:
    """(vec_id, unit array<double>, dim, codes array<long>) of the vectors that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            unit = unit_rows(batch.column(1))
            sizes = sorted({len(v) for v in unit if v is not None})
            for dim in sizes:
                rows = [i for i, v in enumerate(unit) if v is not None and len(v) == dim]
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))
                x = np.stack([unit[i] for i in rows])
                codes = ((x @ planes[dim] > 0).reshape(len(rows), passes, bits) * powers).sum(axis=2)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(pa.float64())),
                    pa.array(np.full(len(rows), dim, np.int32)), pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), passes).cast(pa.list_(pa.int64())),
                ], names=["vec_id", "unit", "dim", "codes"])

    return vectors.mapInArrow(trimmed(run), "vec_id long, unit array<double>, dim int, codes array<long>")


def _ranked(codes: DataFrame) -> DataFrame:
    """(pass, dim, vec_id, rank): the rows of all passes in one distributed sort, numbered."""
    spark = codes.sparkSession
    rows = codes.select("vec_id", "dim", F.posexplode("codes").alias("pass", "code"))
    order = ["pass", "dim", "code", "vec_id"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ordered.select("pass", "dim", "vec_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    before, total = [], 0
    for row in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).orderBy("part").collect():  # a row per partition
        before.append((row["part"], total - row["first"]))
        total += row["n"]
    shift = spark.createDataFrame(before, "part int, shift long")
    return placed.join(F.broadcast(shift), "part").select("pass", "dim", "vec_id", (F.col("at") + F.col("shift")).alias("rank"))


def _labels(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the smallest row reachable."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def passes_for(rows: int, threshold: float, window: int, miss: float) -> int:
    """Passes after which two vectors at ``threshold`` are neighbours in none with probability ``miss``.

    Two ends of a link agree on one sign hash with probability 1 - angle / pi. If hashes halve
    the rows, ends that agree on the first log2(rows / window) of them are within the window.
    """
    depth = max(0.0, log2(max(rows, 1) / window))
    hit = (1 - acos(max(-1.0, min(1.0, threshold))) / pi) ** depth
    return 1 if hit >= 1 else max(1, ceil(log(miss) / log(1 - hit)))


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, miss: float = 0.001, bits: int = 48, window: int = 512, block: int = 1024,
    seed: int = 29, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``key, n_links, component_id, kept`` per vector, by cosine of at least ``threshold``.

    In each pass vectors are ordered by ``bits`` random sign hashes put together, ties by id,
    and every vector is compared with its ``window`` neighbours on either side. There are as many
    passes as keep a link at ``threshold`` from being missed more often than ``miss``, at any
    number of rows (``passes_for``; vectors all on one side of the origin split less evenly and
    may be missed more often). Verified pairs
    of all passes are united; a block of neighbours sends on one link per vector, not its
    pairs. ``n_links`` counts the links inside a component: all pairs of its vectors are
    compared in blocks of ``block`` rows spread over tasks, and only counts leave a task. So a
    link is missed only if all passes fail to join its two ends even through others.

    Vectors that are null, empty or zero, or hold a null, NaN or infinite value, link with
    nothing; so do vectors of different lengths. Rows that repeat an id are one vector (the
    smaller one). A null id links with nothing and stays. An empty table gives no rows; other
    columns are ignored.
    """
    ids = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    named = ids.where("vec_id is not null").groupBy("vec_id").agg(F.min("v").alias("v"))
    passes = passes_for(ids.count(), threshold, window, miss)
    codes = settle(_codes(named, passes, bits, seed))
    units = codes.select("vec_id", "dim", "unit")
    ranked = _ranked(codes)
    places = ranked.withColumn("own", F.floor(F.col("rank") / window)).select(
        "pass", "dim", "vec_id", "rank", "own", F.explode(F.array("own", F.col("own") + 1)).alias("block"))

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        x, name = group["unit"].combine_chunks(), group["vec_id"].to_numpy()
        rank, run = group["rank"].to_numpy(), group["pass"].to_numpy().astype(np.int64) * (1 << 32) + group["dim"].to_numpy()
        new = group["own"].to_numpy() == group["block"].to_numpy()
        out_u, out_v = [], []
        for part in np.unique(run):
            rows = np.flatnonzero(run == part)
            y = matrix(x.take(pa.array(rows)))
            near = y @ y.T >= threshold
            near &= np.abs(rank[rows][:, None] - rank[rows][None, :]) <= window
            near &= new[rows][:, None] | new[rows][None, :]
            label = _labels(near)
            moved = np.flatnonzero(label != np.arange(len(rows)))
            out_u.append(name[rows[moved]])
            out_v.append(name[rows[label[moved]]])
        return pa.table({"u": pa.array(np.concatenate(out_u), pa.int64()), "v": pa.array(np.concatenate(out_v), pa.int64())})

    links = places.join(units.select("vec_id", "unit"), "vec_id").groupBy("block").applyInArrow(compare, "u long, v long")
    members = settle(components(links, "u", "v"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    parts = F.ceil(F.col("size") / block)
    dealt = (
        members.join(sizes, "component").withColumn("parts", parts)
        .withColumn("mine", F.pmod(F.xxhash64("node"), "parts"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("component", F.col("node").alias("vec_id"), "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )

    def count(group: pa.Table) -> pa.Table:
        x, name, mine = matrix(group["unit"]), group["vec_id"].to_numpy(), group["mine"].to_numpy()
        if group["i"][0] == group["j"][0]:
            n = (x @ x.T >= threshold).sum(axis=1) - 1
        else:
            left = mine == group["i"][0].as_py()
            near = x[left] @ x[~left].T >= threshold
            n = np.zeros(len(x), np.int64)
            n[left], n[~left] = near.sum(axis=1), near.sum(axis=0)
        return pa.table({"vec_id": name, "n": pa.array(n, pa.int64())})

    counted = dealt.join(units.select("vec_id", "unit"), "vec_id").groupBy("component", "i", "j").applyInArrow(count, "vec_id long, n long")
    n_links = counted.groupBy("vec_id").agg(F.sum("n").alias("n"))
    out = named.select("vec_id").join(members.withColumnRenamed("node", "vec_id"), "vec_id", "left").join(n_links, "vec_id", "left")
    nameless = ids.where("vec_id is null").select("vec_id", F.lit(None).cast("long").alias("component"), F.lit(None).cast("long").alias("n"))
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", "component", "n").unionByName(nameless).select(
        F.col("vec_id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
