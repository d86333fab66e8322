"""Merkle manifest, decontamination and conversation repair against brute force, and on odd rows."""

from __future__ import annotations

import itertools
import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from kerbline.llm import decontaminate, merkle, repair

DOCS = "doc_id long, source string, text string, key string, node string, total long"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def naive_tree(leaves: list[str], arity: int) -> tuple[str, list[str]]:
    """Root and, per leaf, the digests of all its siblings in one string."""
    proofs, nodes, spots = [""] * len(leaves), leaves, list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for i, at in enumerate(spots):
            run = runs[at // arity]
            proofs[i] += "".join(run[: at % arity] + run[at % arity + 1 :])
            spots[i] = at // arity
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], proofs


def naive_manifest(rows: list[tuple], arity: int) -> list[tuple]:
    groups: dict[str, list] = {}
    for doc_id, source, text, *_ in rows:
        value = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, text)]
        groups.setdefault(source, []).append((-1 if doc_id is None else doc_id, h("".join(value)), doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = [naive_tree([leaf for _, leaf, _ in sorted(groups[s])], arity) for s in names]
    root, upper = naive_tree([r for r, _ in made], arity)
    return [(doc_id, leaf, sub, root, h(proof + tail)) for s, (sub, proofs), tail in zip(names, made, upper) for (_, leaf, doc_id), proof in zip(sorted(groups[s]), proofs)]


def manifest_of(spark, rows: list[tuple], shape: merkle.Shape):
    docs = spark.createDataFrame(rows, DOCS)
    return merkle.manifest(docs, merkle.row_digest(["doc_id", "source", "text"]), shape=shape, carry={"claimed": F.lit(h("other"))})


def ordered(rows) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("shape", [merkle.Shape(2, 1), merkle.Shape(3, 2), merkle.Shape()], ids=str)
def test_manifest_equals_a_plain_tree(spark, shape):
    draw = random.Random(4)
    sources = [None, "", "a", "é", "Z", *[f"s{i}" for i in range(7)]]
    rows = [(i, draw.choice(sources), draw.choice(["", None, "x", "Ünï", f"t{i}"]), "key", None, i) for i in range(90)]
    rows += [(1000 + i, "hot", f"t{i}", None, "n", 0) for i in range(60)] + [(None, "hot", None, None, None, None)] + [(2000, "a", "again", "k", "n", 1)] * 3
    rows += [(3000, "lone", "x" * 200_000, None, None, None)]
    got = manifest_of(spark, rows, shape).select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("witness")).alias("p"),
        merkle.fold(F.col("leaf"), F.col("witness")).alias("f"), merkle.fold(F.col("claimed"), F.col("witness")).alias("g"),
    ).collect()
    assert ordered(r[:5] for r in map(tuple, got)) == ordered(naive_manifest(rows, shape.arity))
    assert all(r["f"] == r["root"] and r["g"] != r["root"] for r in got)


def test_manifest_of_nothing_and_of_one_row(spark):
    assert manifest_of(spark, [], merkle.Shape()).count() == 0
    (row,) = manifest_of(spark, [(5, None, None, None, None, None)], merkle.Shape()).collect()
    assert row["root"] == row["subroot"] == row["leaf"] == h("1:5--") and row["witness"] == [] and row["source"] is None


def test_frontier_extends_open_witnesses_only():
    edge = merkle.Frontier(2, 2)
    seen: list[list] = [[], [], []]
    edge.append("a", seen[0])
    assert seen[0] == []
    edge.append("b", seen[1])
    assert seen[:2] == [[(0, "b")], [(1, "a")]]
    edge.append("c", seen[2])
    root = edge.close()
    ab, c = h("ab"), h("c")
    assert root == h(ab + c) and seen == [[(0, "b"), (0, c)], [(1, "a"), (0, c)], [(0, ""), (1, ab)]]


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def naive_hits(text: str | None, items: list[tuple], size: int) -> tuple[int, int, list[str]]:
    w, hit, found = words(text), set(), set()
    for item, other in items:
        v = words(other)
        for i in range(max(len(v) - size + 1, 1)) if v else ():
            part = v[i : i + size]
            for j in range(len(w) - len(part) + 1):
                if w[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def check_hits(spark, docs: list[tuple], items: list[tuple], rule: decontaminate.Rule):
    d = spark.createDataFrame(docs, "doc_id long, text string, window string, item string, start long")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, window string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(d, b, rule).collect())
    assert got == sorted((i is None, i or 0, *naive_hits(t, items, rule.window)) for i, t, *_ in docs)


@pytest.mark.parametrize("rule", [decontaminate.Rule(), decontaminate.Rule(4, 2, 60), decontaminate.Rule(3, 5, 50)], ids=str)
def test_hits_equal_a_plain_search(spark, rule):
    draw = random.Random(9)

    def text(n: int) -> str:
        return draw.choice([" ", ", ", "\n", "-"]).join(draw.choice(["a", "B", "c", "Éa", "éa", "7", "the", "日本"]) for _ in range(n))

    items = [(i, text(draw.randint(4, 30))) for i in range(12)] + [(100, None), (101, " .,"), (102, "Zebra"), (103, "zebra crossing"), (None, "one two three"), (3, text(12)), (3, text(12))]
    bodies = [t for _, t in items if t]
    docs = [(i, " ".join([text(draw.randint(0, 20)), draw.choice(bodies), text(draw.randint(0, 20))])) for i in range(25)]
    docs += [(50, None), (51, ""), (52, "zebra"), (53, "ZEBRA-Crossing zebra"), (None, "one Two, three"), (54, "one two"), (55, bodies[0]), (55, bodies[0]), (55, bodies[1])]
    docs += [(56, " ".join(bodies) + " filler" * 20_000)]
    check_hits(spark, [(*d, "w", "i", 1) for d in docs], items, rule)


def test_hits_of_nothing(spark):
    check_hits(spark, [], [(1, "a b c")], decontaminate.Rule())
    check_hits(spark, [(1, "a b c", "", "", 0)], [], decontaminate.Rule())
    check_hits(spark, [(1, "a b c", "", "", 0)], [(1, None), (2, "..")], decontaminate.Rule())


# conversation repair


def naive_repair(turns: list[tuple]) -> tuple[int, str, list[tuple[str, str]]]:
    """The best of all edit sequences of small cost, by trying every one."""
    best: tuple | None = None
    budget = 3 * len(turns)

    def legal(roles: str) -> bool:
        return re.fullmatch("(s?(ua)+)?", roles) is not None

    def go(i: int, cost: int, audit: str, out: list[tuple[str, str]], inserts: int) -> None:
        nonlocal best
        if cost > budget or (best and cost > best[0]):
            return
        if i == len(turns) and legal("".join(r[:1] for r, _ in out) if all(r for r, _ in out) else "x"):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, out)
        if inserts < 2:
            for name in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*out, (name, "")], inserts + 1)
        if i < len(turns):
            role, text, drop, late = turns[i]
            go(i + 1, cost + 3, audit + "D", out, 0)
            if not drop:
                go(i + 1, cost + late, audit + "K", [*out, (role, text)], 0)
                for name in ("user", "assistant"):
                    go(i + 1, cost + 2 + late, audit + "R", [*out, (name, text)], 0)

    go(0, 0, "", [], 0)
    return best


def test_survivors_find_the_least_of_all_edits():
    draw = random.Random(2)
    for _ in range(150):
        turns = [(draw.choice(["user", "assistant", "system", "tool", ""]), f"t{i}", draw.random() < 0.15, draw.random() < 0.3) for i in range(draw.randint(0, 4))]
        edits: list[tuple] = []
        alive = repair.Survivors(lambda *e: edits.append(e))
        for turn in turns:
            alive.turn(*turn)
        cost = alive.finish()
        assert (cost, "".join(e[0] for e in edits), [e[1:] for e in edits if e[0] != "D"]) == naive_repair(turns), turns


def test_survivors_hold_few_edits_of_a_long_conversation():
    draw = random.Random(3)

    def size(node: repair.Node) -> int:
        return 1 + sum(map(size, node.kids.values()))

    done: list[str] = []
    alive = repair.Survivors(lambda letter, role, text: done.append(letter))
    most = 0
    for i in range(20_000):
        alive.turn(draw.choice(["user", "assistant", "system"]), f"t{i}", draw.random() < 0.1, draw.random() < 0.2)
        most = max(most, size(alive.root))
    alive.finish()
    assert most < 200 and len(done) - done.count("I") == 20_000


CHAT = "conv_id long, turn long, role string, text string, present boolean, fault string"


def test_repair_of_odd_rows(spark):
    rows = [
        (1, 0, "user", "hi.", True, "x"), (1, 1, "assistant", "yes.", True, None), (1, 1, "assistant", "yes.", True, None), (1, 5, "user", None, True, None),
        (2, None, None, "t.", True, None), (2, None, "user", "no end", True, None), (2, 7, "", "", True, None),
        (3, 4, "user", "gone.", False, None), (None, 2, "system", "s.", True, None), (None, 3, "user", "long " * 50_000 + "!", True, None), (None, 9, "user", "a?\n", True, None),
    ]
    turns = spark.createDataFrame(rows, CHAT)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.summarise(turns, F.col("present")).collect()}
    assert got[1] == (3, 1, 1, 0, 1, 6, "KKDD", h("user:hi.\nassistant:yes."))
    assert got[2] == (0, 1, 0, 1, 2, 8, "RRD", h("user:t.\nassistant:no end"))
    assert got[3] == (0, 0, 0, 0, 0, 0, "", h(""))
    assert got[None][:6] == (5, 0, 0, 0, 1, 2)
    lines = {c: [] for c in got}
    for r in repair.repair(turns, F.col("present")).orderBy("step").collect():
        if r["edit"] != "D":
            lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert {c: h("\n".join(x)) for c, x in lines.items()} == {c: r[-1] for c, r in got.items()}
    assert repair.summarise(turns.where("false")).count() == 0 == repair.repair(turns.where("false")).count()


def test_repair_over_many_conversations(spark):
    draw = random.Random(8)
    rows = [(c, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", "", " \n", f"c{t}!"]), True, None) for c in range(40) for t in range(draw.randint(1, 4))]
    got = {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in repair.summarise(spark.createDataFrame(rows, CHAT)).collect()}
    for conv, group in itertools.groupby(rows, lambda r: r[0]):
        turns, seen = [], set()
        for _, _, role, text, *_ in group:
            drop = not text.strip() or (role, text) in seen
            seen.add((role, text))
            turns.append((role, text, drop, not drop and text.strip()[-1] not in ".!?"))
        cost, audit, out = naive_repair(turns)
        assert got[conv] == (cost, audit, h("\n".join(f"{r}:{t}" for r, t in out))), turns
