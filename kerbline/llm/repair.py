"""Cheapest repair of a conversation's structure: Viterbi with survivor coalescence.

A conversation is read turn by turn. Per state of the role machine the cheapest edits so far
survive, as a leaf of a tree of back pointers. A node without survivors below it is dropped at
once, and as soon as all survivors share their first edit, that edit is final and handed out.
So a task holds the unresolved edits of one conversation, however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kerbline.llm.textscan import trimmed

SPACE = r"\x20\x09-\x0D"
#: What the roles' initials may lead to: an optional s, then pairs of u and a.
NEXT = {"start": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FINAL = ("start", "a")
NAMES = {"u": "user", "a": "assistant"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1

    @property
    def reach(self) -> int:
        """What any state needs at most to do as well as any other from here on."""
        return 2 * self.insert + self.delete


class Node:
    """An edit and the edits that survive after it."""

    __slots__ = ("parent", "letter", "role", "text", "depth", "kids", "pinned")

    def __init__(self, parent: Node | None, letter: str, role: str | None, text: str | None):
        self.parent, self.letter, self.role, self.text = parent, letter, role, text
        self.depth = parent.depth + 1 if parent else 0
        self.kids: dict[str, Node] = {}
        self.pinned = 0


def _earlier(a: Node, b: Node) -> bool:
    """Whether the edits up to ``a`` are the less string; neither is a beginning of the other."""
    while a.depth > b.depth:
        a = a.parent
    while b.depth > a.depth:
        b = b.parent
    while a.parent is not b.parent:
        a, b = a.parent, b.parent
    return a.letter < b.letter


class Survivors:
    """The survivors of one conversation; ``emit(letter, role, text)`` gets each final edit."""

    def __init__(self, emit: Callable[[str, str | None, str | None], None], costs: Costs = Costs()):
        self.emit, self.costs = emit, costs
        self.root = Node(None, "", None, None)
        self.root.pinned = 1
        self.best: dict[str, tuple[int, Node]] = {"start": (0, self.root)}

    def _less(self, a: tuple[int, Node, tuple], b: tuple[int, Node, tuple]) -> bool:
        if a[0] != b[0]:
            return a[0] < b[0]
        if a[1] is b[1]:
            return [e[0] for e in a[2]] < [e[0] for e in b[2]]
        return _earlier(a[1], b[1])

    def _inserted(self) -> Iterator[tuple[str, int, Node, tuple]]:
        """Every survivor with up to two inserted turns; more never pay."""
        for state, (cost, node) in self.best.items():
            edits: tuple = ()
            yield state, cost, node, edits
            for _ in range(2):
                state = NEXT[state]["u" if "u" in NEXT[state] else "a"]
                cost, edits = cost + self.costs.insert, (*edits, ("I", NAMES[state], ""))
                yield state, cost, node, edits

    def turn(self, role: str, text: str, drop: bool, truncated: bool) -> None:
        found: dict[str, tuple[int, Node, tuple]] = {}

        def offer(state: str, cost: int, node: Node, edits: tuple) -> None:
            new = (cost, node, edits)
            if state not in found or self._less(new, found[state]):
                found[state] = new

        late = self.costs.truncated if truncated else 0
        for state, cost, node, edits in self._inserted():
            offer(state, cost + self.costs.delete, node, (*edits, ("D", None, None)))
            if drop:
                continue
            after = NEXT[state].get(role[:1])
            if after:
                offer(after, cost + late, node, (*edits, ("K", role, text)))
            for initial, name in NAMES.items():
                if initial in NEXT[state]:
                    offer(NEXT[state][initial], cost + self.costs.rerole + late, node, (*edits, ("R", name, text)))
        least = min(c for c, _, _ in found.values())
        self._replace({s: f for s, f in found.items() if f[0] <= least + self.costs.reach})

    def _replace(self, found: dict[str, tuple[int, Node, tuple]]) -> None:
        before = [node for _, node in self.best.values()]
        self.best = {}
        for state, (cost, node, edits) in found.items():
            for letter, role, text in edits:
                if letter not in node.kids:
                    node.kids[letter] = Node(node, letter, role, text)
                node = node.kids[letter]
            node.pinned += 1
            self.best[state] = (cost, node)
        for node in before:
            node.pinned -= 1
            while node.parent is not None and not node.pinned and not node.kids:
                del node.parent.kids[node.letter]
                node = node.parent
        while not self.root.pinned and len(self.root.kids) == 1:
            (self.root,) = self.root.kids.values()
            self.root.parent = None
            self.emit(self.root.letter, self.root.role, self.root.text)

    def finish(self) -> int:
        """Hand out what is left; returns the whole cost."""
        ends = [(cost, node, edits) for state, cost, node, edits in self._inserted() if state in FINAL]
        best = ends[0]
        for end in ends[1:]:
            if self._less(end, best):
                best = end
        self._replace({"end": best})
        return best[0]


def faults(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, turn, role, text, present, fault`` in the order in which conversations are read.

    ``fault`` is ``blank`` (no character but ASCII white space), ``duplicate`` (role and text
    stood earlier in the conversation), ``truncated`` (the last such character is none of
    ``.!?``) or null, the first that holds. Null roles and texts count as one space. Turns
    ascend, nulls first, ties by role and text. A task gets whole conversations, in order.
    """
    kept = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), kept.alias("present"))
    rows = rows.withColumns({c: F.when(F.col("present"), F.col(c)) for c in ("role", "text")}).repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(~F.col("text").rlike(f"[^{SPACE}]"), "blank").when(F.col("__copy") > 1, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated")
    )
    return (
        rows.withColumn("__copy", F.row_number().over(same)).withColumn("fault", F.when(F.col("present"), fault))
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "__copy")
        .select("conv_id", "turn", "role", "text", "present", "fault")
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Successive conversations of a sorted task, each as an iterator of its rows."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        conv = ahead[0]

        def turns() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == conv:
                row, ahead = ahead, next(rows, None)
                yield row

        group = turns()
        yield conv, group
        for _ in group:  # what the reader left
            pass


REPAIRED = "step long, edit string, role string, text string"


def repair(turns: DataFrame, present: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """One row per edit: ``conv_id, step, edit, role, text``, the cheapest way to a legal conversation.

    A conversation is legal when its roles' initials read ``(s?(ua)+)?``. A turn may be kept
    (K), given the role user or assistant (R) or deleted (D, the only way for blank and
    duplicate turns); an empty turn may be inserted anywhere (I). Among equally cheap ways the
    edits least in ASCII order win. Deleted turns have no role and text. ``present`` leaves rows
    out. An empty table gives no rows; null ids are one conversation; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, rows in _conversations(batches):
            step = 0

            def emit(letter: str, role: str | None, text: str | None) -> None:
                nonlocal step
                out.append((conv, step, letter, role, text))
                step += 1

            alive = Survivors(emit, costs)
            for _, _, role, text, there, fault in rows:
                if there:
                    alive.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")
                if len(out) >= 5_000:
                    yield _batch(out, kind)
                    out.clear()
            alive.finish()
        if out:
            yield _batch(out, kind)

    ordered = faults(turns, present)
    id_type = ordered.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, {REPAIRED}"
    kind = _arrow(schema)
    return ordered.mapInArrow(trimmed(run), schema)


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = ("su", "ua", "au")


def summarise(turns: DataFrame, present: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """One row per conversation: its faults, the cost and edits of the repair, and its digest.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``: turn
    numbers missing between the first and last, turns per fault, neighbours whose roles'
    initials are not su, ua or au, and the repair of :func:`repair`, its edits as one string and
    its turns as ``role:text`` lines hashed as they become final. A conversation whose rows are
    all left out by ``present`` is listed with zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, rows in _conversations(batches):
            audit, seen = [], sha256()
            kept = 0

            def emit(letter: str, role: str | None, text: str | None) -> None:
                nonlocal kept
                audit.append(letter)
                if letter != "D":
                    seen.update(f"{chr(10) if kept else ''}{role}:{text}".encode())
                    kept += 1

            alive = Survivors(emit, costs)
            counts = {"blank": 0, "duplicate": 0, "truncated": 0}
            first = last = before = None
            distinct = illegal = 0
            for _, turn, role, text, there, fault in rows:
                if not there:
                    continue
                if fault:
                    counts[fault] += 1
                if turn is not None and turn != last:
                    first, last, distinct = (turn if first is None else first), turn, distinct + 1
                if before is not None and before + role[:1] not in LEGAL:
                    illegal += 1
                before = role[:1]
                alive.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")
            cost = alive.finish()
            gaps = last - first + 1 - distinct if distinct else 0
            out.append((conv, gaps, *counts.values(), illegal, cost, "".join(audit), seen.hexdigest()))
            if len(out) >= 5_000:
                yield _batch(out, kind)
                out.clear()
        if out:
            yield _batch(out, kind)

    ordered = faults(turns, present)
    schema = f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {SUMMARY}"
    kind = _arrow(schema)
    return ordered.mapInArrow(trimmed(run), schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)
