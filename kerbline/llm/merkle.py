"""A Merkle manifest of a table: every row's witness up to one root, built by aligned appends.

Rows of a group are appended in order to a :class:`Frontier`, which keeps only the open right
edge of the tree. Each appended row brings an empty witness; whenever a run of siblings is
complete, the witnesses of all rows below are extended by the siblings of their ancestor in
that run. A group of any size is cut into aligned blocks of ``arity ** levels`` rows, each
appended in a task of its own; the roots of the blocks are then appended as the rows of the
next tier, and so on until each group has one node. The groups' nodes are in turn the rows of
the last tree. On the way down each block hands the witness of its root to its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.session import settle

HEX = 64
WITNESS = "array<struct<slot:int,siblings:string>>"


@dataclass(frozen=True)
class Shape:
    """``arity`` nodes become one; a task appends blocks of ``arity ** levels`` nodes."""

    arity: int = 16
    levels: int = 3

    @property
    def block(self) -> int:
        return self.arity**self.levels

    def height(self, total: int) -> int:
        """Levels above ``total`` nodes until one is left."""
        height, width = 0, 1
        while width < total:
            height, width = height + 1, width * self.arity
        return height


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Frontier:
    """The open right edge of a tree of fixed height.

    ``append`` takes the next node and the list that collects its witness: (slot among the
    siblings, the siblings' digests in order) per level, from the bottom up. A run is complete
    after ``arity`` nodes, or at ``close``, which completes what is open, runs of one included.
    """

    def __init__(self, height: int, arity: int):
        self.height, self.arity = height, arity
        self.open: list[list[tuple[str, list[list]]]] = [[] for _ in range(height + 1)]

    def append(self, node: str, witness: list | None = None) -> None:
        self._add(0, node, [] if witness is None else [witness])

    def _add(self, level: int, node: str, below: list[list]) -> None:
        self.open[level].append((node, below))
        if level < self.height and len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _ in run]
        for slot, (_, below) in enumerate(run):
            if below:
                step = (slot, "".join(nodes[:slot] + nodes[slot + 1 :]))
                for witness in below:
                    witness.append(step)
        self._add(level + 1, digest("".join(nodes)), [w for _, below in run for w in below])

    def close(self) -> str:
        for level in range(self.height):
            if self.open[level]:
                self._complete(level)
        return self.open[self.height][0][0]


def row_digest(columns: dict[str, Column] | list[str]) -> Column:
    """SHA-256 of a row: per column ``-`` for null, else the UTF-8 length, ``:`` and the value as text."""
    values = columns.values() if isinstance(columns, dict) else [F.col(c) for c in columns]

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def fold(node: Column, witness: Column) -> Column:
    """The root that a node and its witness lead to."""

    def up(below: Column, step: Column) -> Column:
        cut = step["slot"] * HEX
        left, right = F.substring(step["siblings"], F.lit(1), cut), F.substring(step["siblings"], cut + 1, F.length(step["siblings"]))
        return F.sha2(F.concat(left, below, right), 256)

    return F.aggregate(witness, node, up)


def siblings_digest(witness: Column) -> Column:
    """SHA-256 of all siblings of a witness, from the bottom up and left to right."""
    return F.sha2(F.array_join(witness["siblings"], ""), 256)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0) and ``total`` of their ``key``, in ``order``.

    Rows are dealt to tasks by ranges of (key, order), so a group with most rows spans many
    tasks; a position is the row's place in its task plus the rows of the group in tasks before.
    """
    spread = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    kept = settle(spread.withColumns({"__task": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    here = kept.groupBy("key", "__task").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    group = Window.partitionBy("key")
    earlier = group.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = here.select(
        "key", "__task", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(group).alias("total"),
    )
    return kept.join(shifts, ["key", "__task"]).withColumn("pos", F.col("__row") + F.col("__shift")).drop("__task", "__row", "__shift")


def _run(table: pa.Table, shape: Shape, witnesses: list | None) -> str:
    total = table.column("total")[0].as_py()
    edge = Frontier(min(shape.levels, shape.height(total)), shape.arity)
    nodes = table.column("node").to_pylist()
    for i, node in enumerate(nodes):
        edge.append(node, None if witnesses is None else witnesses[i])
    return edge.close()


def _tiers(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """``nodes`` and, tier by tier, the roots of its blocks; the last tier has one node per key."""

    def root(keys: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = -(-table.column("total")[0].as_py() // shape.block)
        return pa.table({"key": [keys[0].as_py()], "pos": [keys[1].as_py()], "total": pa.array([total], pa.int64()), "node": [_run(table, shape, None)]})

    most = nodes.agg(F.max("total")).first()[0] or 0
    tiers = [nodes]
    while len(tiers) == 1 or most > 1:
        narrow = tiers[-1].select("key", "pos", "total", "node", F.expr(f"pos div {shape.block}").alias("__block"))
        tiers.append(settle(narrow.groupBy("key", "__block").applyInArrow(root, "key string, pos long, total long, node string")))
        most = -(-most // shape.block)
    return tiers


def _hand_down(tiers: list[DataFrame], above: DataFrame, shape: Shape) -> DataFrame:
    """The rows of the first tier with the columns of ``above`` and their whole ``witness``.

    ``above`` has, per node of the last tier, ``key``, ``pos``, ``witness`` and other columns.
    """
    carried = [f for f in above.schema.fields if f.name not in ("key", "pos", "witness")]
    for nodes in reversed(tiers[:-1]):
        own = [f for f in nodes.schema.fields if f.name != "total"]
        schema = T.StructType([*own, *carried, above.schema["witness"]])
        cut = nodes.withColumn("__block", F.expr(f"pos div {shape.block}"))
        tail = above.withColumnRenamed("pos", "__block")
        extend = _extension(shape, [f.name for f in own], [f.name for f in carried])
        above = cut.groupBy("key", "__block").cogroup(tail.groupBy("key", "__block")).applyInArrow(extend, schema)
    return above


def _extension(shape: Shape, own: list[str], carried: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Append a block and extend the witnesses of its rows by that of its root."""

    def extend(mine: pa.Table, upper: pa.Table) -> pa.Table:
        mine = mine.sort_by("pos")
        found: list[list] = [[] for _ in range(mine.num_rows)]
        _run(mine, shape, found)
        rest = [(s["slot"], s["siblings"]) for s in upper.column("witness")[0].as_py()]
        steps, offsets = [], [0]
        for witness in found:
            steps += [*witness, *rest]
            offsets.append(len(steps))
        pairs = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.int32()), pa.array([s[1] for s in steps], pa.string())], ["slot", "siblings"])
        shared = {n: pa.array([upper.column(n)[0].as_py()] * mine.num_rows, upper.schema.field(n).type) for n in carried}
        return pa.table({**{n: mine.column(n) for n in own}, **shared, "witness": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)})

    return extend


def manifest(docs: DataFrame, leaf: Column, by: str = "source", order: str = "doc_id", carry: dict[str, Column] | None = None,
             shape: Shape = Shape()) -> DataFrame:
    """One row per input row: ``order, by, leaf, *carry, subroot, root, witness``.

    ``leaf`` is a digest as hex text (:func:`row_digest`). The rows of each ``by`` ascend by
    ``order`` (nulls first), then ``leaf``; runs of ``shape.arity`` become one node until one is
    left, the ``subroot`` (a lone leaf is its own). The subroots, by ``by`` (null first, by
    bytes), become ``root`` likewise. ``witness`` is an array of (slot, siblings' digests in one
    string) from the leaf to the root; :func:`fold` recomputes the root from it. ``carry``
    columns travel along and have no effect.

    Equal rows have equal leaves and get neighbouring places; which is which can't be told.
    Texts are hashed where they are read and travel no further. Empty and null values are told
    apart by the leaf; an empty table gives no rows; columns not named are ignored.
    """
    carry = carry or {}
    key = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))  # null sorts first and groups with itself
    leaves = docs.select(key.alias("key"), F.col(order).alias("__order"), F.col(by).alias("__by"), leaf.alias("node"), *[c.alias(f"__c_{n}") for n, c in carry.items()])
    tiers = _tiers(_placed(leaves, ["__order", "node"]), shape)
    groups = tiers[-1].select(F.lit("").alias("key"), F.col("key").alias("__group"), "node")
    upper = _tiers(_placed(groups, ["__group"]), shape)
    whole = upper[-1].select("key", "pos", F.col("node").alias("root"), F.expr(f"CAST(array() AS {WITNESS})").alias("witness"))
    tops = _hand_down(upper, whole, shape).select(F.col("__group").alias("key"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("subroot"), "root", "witness")
    rows = _hand_down(tiers, settle(tops), shape)
    return rows.select(
        F.col("__order").alias(order), F.col("__by").alias(by), F.col("node").alias("leaf"), *[F.col(f"__c_{n}").alias(n) for n in carry], "subroot", "root", "witness",
    )
