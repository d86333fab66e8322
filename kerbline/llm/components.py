"""Connected components of a distributed list of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.textscan import trimmed
from kerbline.session import settle


#: Nodes that a task keeps before it sends their stars on.
PORTION = 200_000


class Union:
    """Sets of whole numbers in one task; the smallest member names a set."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        above = self.above
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        """Unite two sets; False if they were one."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links (two columns) of one task by stars, in portions that bound its memory."""
    sets = Union()

    def stars() -> pa.RecordBatch:
        nodes = list(sets.above)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([sets.root(x) for x in nodes], pa.int64())], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(a, b)
        if len(sets.above) > PORTION:
            yield stars()
            sets = Union()
    yield stars()


def components(links: DataFrame, a: str, b: str, contracted: bool = False) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each task first replaces its links by stars (:func:`contract`), unless the tasks that made
    them have done so already (``contracted``). Then "large star" and "small star" rounds hang
    every node on smaller ones: both are a minimum per node (pre-aggregated before the shuffle)
    and a join, so a hub with a third of all links is neither collected nor walked by one task.
    Rounds end when nothing changes; their number grows with the logarithm of the longest path.
    Every round is written to the shared checkpoint folder.
    """
    ends = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    edges = settle(ends if contracted else ends.mapInArrow(trimmed(contract), "u long, v long"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(least, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = settle(small.where("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now
