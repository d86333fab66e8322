"""Toxicity: a lexicon trie met with Levenshtein automata, and scores of each hit's context."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.importance import bounded_labels, find
from kerbline.llm.textscan import LOWER, slices, span_hashes, trimmed
from kerbline.session import settle

LETTER = np.zeros(256, bool)
LETTER[48:58] = LETTER[97:123] = LETTER[128:] = True
LONGEST = 40

#: Terms of one automaton.
PORTION = 24
STEMS = (4, 5, 6)
#: Kinds of hits: exact, misspelled, word that begins with a stem.
EXACT, TYPO, STEM = 0, 1, 2
FEATURES = ("exact", "exact_quoted", "typo", "typo_quoted", "stem", "stem_quoted", "near_another", "weight")


def plain(data: np.ndarray) -> np.ndarray:
    """Lower-case copy of the bytes with typographic quotation marks as ``"`` and blanks."""
    out = LOWER[data]
    n = len(out)
    if n > 2:
        curly = np.flatnonzero((out[:-2] == 0xE2) & (out[1:-1] == 0x80) & (out[2:] >= 0x9C) & (out[2:] <= 0x9F))
        out[curly], out[curly + 1], out[curly + 2] = 34, 32, 32
    if n > 1:
        angle = np.flatnonzero((out[:-1] == 0xC2) & ((out[1:] == 0xAB) | (out[1:] == 0xBB)))
        out[angle], out[angle + 1] = 34, 32
    return out


def letter_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of letters and digits."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def edits_for(term: str | bytes) -> int:
    """Edits that a term may be away: none below 5 letters, two from 9 on."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass(frozen=True)
class Automaton:
    """One deterministic automaton for all terms: the product of trie and edit counters."""

    column: np.ndarray
    step: np.ndarray
    term: np.ndarray
    kind: np.ndarray
    used: np.ndarray

    def states(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The state after each word; all words take a step together."""
        state = np.ones(len(starts), np.int32)
        length = ends - starts
        live = np.arange(len(starts))
        depth = 0
        while len(live):
            live = live[(length[live] > depth) & (state[live] > 0)]
            state[live] = self.step[state[live], self.column[data[starts[live] + depth]]]
            depth += 1
        return state

    def read(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The term (-1: none) and kind of hit of each word."""
        state = self.states(data, starts, ends)
        return self.term[state], self.kind[state]


@dataclass(frozen=True)
class Automata:
    """An automaton for every ``PORTION`` terms, with the numbers of its terms.

    The states of one automaton grow faster than its terms; those of many grow with them.
    """

    parts: list[tuple[Automaton, np.ndarray]]

    def read(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As one automaton of all terms: fewest edits, then words before stems, then the first term."""
        term, kind = np.full(len(starts), -1, np.int32), np.full(len(starts), -1, np.int8)
        best = np.full(len(starts), np.iinfo(np.int64).max)
        for automaton, numbers in self.parts:
            state = automaton.states(data, starts, ends)
            hit = np.flatnonzero(automaton.term[state] >= 0)
            state = state[hit]
            number = numbers[automaton.term[state]]
            rank = ((automaton.used[state].astype(np.int64) * 2 + (automaton.kind[state] == STEM)) << 32) + number
            better = rank < best[hit]
            at = hit[better]
            best[at], term[at], kind[at] = rank[better], number[better], automaton.kind[state[better]]
        return term, kind


def compile_portions(terms: list[bytes], stems: list[bytes]) -> Automata:
    """Automata of all terms and stems; numbers count terms first."""
    parts = []
    for i in range(0, len(terms), PORTION):
        some = terms[i : i + PORTION]
        parts.append((compile_terms(some, []), np.arange(i, i + len(some))))
    if stems:
        parts.append((compile_terms([], stems), len(terms) + np.arange(len(stems))))
    return Automata(parts)


def compile_terms(terms: list[bytes], stems: list[bytes]) -> Automaton:
    """Determinise, for each term, its Levenshtein automaton along the shared trie of all terms.

    A state is a set of (trie node, edits so far); dominated members are left out. Stems take no
    edits and accept whatever follows. Edits count UTF-8 bytes.
    """
    if not terms and not stems:
        return Automaton(np.zeros(256, np.int16), np.zeros((2, 1), np.int32), np.full(2, -1, np.int32), np.full(2, -1, np.int8), np.zeros(2, np.int8))
    children: list[dict[int, int]] = []
    last: list[int] = []
    roots: dict[tuple[int, bool], int] = {}

    def node() -> int:
        children.append({})
        last.append(-1)
        return len(children) - 1

    every = [*terms, *stems]
    for number, term in enumerate(every):
        group = (0, True) if number >= len(terms) else (edits_for(term), False)
        at = roots[group] if group in roots else roots.setdefault(group, node())
        for byte in term:
            at = children[at][byte] if byte in children[at] else children[at].setdefault(byte, node())
        last[at] = number if last[at] < 0 else last[at]
    allowed, is_stem = {}, set()
    for (edits, stem), root in roots.items():
        stack = [root]
        while stack:
            at = stack.pop()
            allowed[at] = edits
            if stem:
                is_stem.add(at)
            stack += children[at].values()

    def closed(items: dict[int, int]) -> frozenset[tuple[int, int]]:
        stack = list(items.items())
        while stack:
            at, used = stack.pop()
            if used < allowed[at]:
                for child in children[at].values():
                    if used + 1 < items.get(child, 99):
                        items[child] = used + 1
                        stack.append((child, used + 1))
        return frozenset(items.items())

    used_bytes = sorted({b for t in every for b in t})
    column = np.zeros(256, np.int16)
    column[used_bytes] = np.arange(1, len(used_bytes) + 1)
    start = closed({root: 0 for root in roots.values()})
    states: dict[frozenset[tuple[int, int]], int] = {frozenset(): 0, start: 1}
    rows: list[list[int]] = [[0] * (len(used_bytes) + 1)]
    todo = [start]
    while todo:
        items = todo.pop(0)
        row = []
        for byte in [-1, *used_bytes]:
            to: dict[int, int] = {}
            for at, used in items:
                if at in is_stem and last[at] >= 0:
                    to[at] = 0
                    continue
                child = children[at].get(byte)
                if child is not None:
                    to[child] = min(used, to.get(child, 99))
                if used < allowed[at]:
                    to[at] = min(used + 1, to.get(at, 99))
                    for other in children[at].values():
                        to[other] = min(used + 1, to.get(other, 99))
            new = closed(to)
            if new not in states:
                states[new] = len(states)
                todo.append(new)
            row.append(states[new])
        rows.append(row)
    term, kind, edits_used = np.full(len(states), -1, np.int32), np.full(len(states), -1, np.int8), np.zeros(len(states), np.int8)
    for items, number in states.items():
        hits = [(used, at in is_stem, last[at]) for at, used in items if last[at] >= 0]
        if hits:
            used, stem, best = min(hits)
            term[number], kind[number], edits_used[number] = best, STEM if stem else TYPO if used else EXACT, used
    return Automaton(column, np.array(rows, np.int32), term, kind, edits_used)


@dataclass(frozen=True)
class Lexicon:
    terms: list[str]
    stems: list[str]
    weights: list[float]


def learn_lexicon(
    docs: DataFrame, ids: np.ndarray, toxic: np.ndarray, least_share: float = 0.005, least_docs: int = 3,
    key: str = "doc_id", text: str = "text",
) -> Lexicon:
    """Words and word stems that labelled toxic documents hold and labelled clean ones don't.

    A term is taken if it is in ``least_docs`` toxic documents and ``least_share`` of them, and
    if, at equal shares of both kinds, at least nine in ten documents with it would be toxic.
    These shares alone bound the list. A stem is taken only where no word or shorter stem
    already accounts for most of its documents; words of any length may be terms.
    """
    sample = docs.sparkSession.sparkContext.broadcast((ids, toxic))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, labels = sample.value
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            at, known = find(names, batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False))
            rows = np.flatnonzero(known)
            for first, data, offs in slices(batch.column(1).take(pa.array(rows))):
                data = plain(data)
                starts, ends, row = letter_words(data, offs)
                raw = data.tobytes()
                edges = np.searchsorted(row, np.arange(len(offs)))
                for i in range(len(offs) - 1):
                    mine = {raw[a:b] for a, b in zip(starts[edges[i] : edges[i + 1]].tolist(), ends[edges[i] : edges[i + 1]].tolist(), strict=True) if b - a <= LONGEST}
                    kind = int(labels[at[rows[first + i]]] > 0)
                    found[kind].update(mine)
                    found[kind].update({w[:n] + b"*" for w in mine for n in STEMS if len(w) > n})
        terms = list(found[0].keys() | found[1].keys())
        for i in range(0, len(terms), 50_000):
            part = terms[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([found[1][t] for t in part], pa.int64()), pa.array([found[0][t] for t in part], pa.int64())], names=["term", "toxic", "clean"])

    n_toxic, n_clean = max(1, int((toxic > 0).sum())), max(1, int((toxic <= 0).sum()))
    counted = docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(trimmed(run), "term binary, toxic long, clean long")
    total = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share, other = F.col("toxic") / n_toxic, (F.col("clean") + F.lit(0.1)) / n_clean
    good = total.where((F.col("toxic") >= max(least_docs, least_share * n_toxic)) & (share >= 9 * other))
    rows = good.orderBy(F.desc("toxic"), "term").collect()  # bounded by the share of labelled documents
    taken: list[tuple[bytes, float]] = []
    words = {bytes(r["term"]): r for r in rows if not bytes(r["term"]).endswith(b"*")}
    for r in rows:
        term = bytes(r["term"])
        if term.endswith(b"*"):
            inside = max((w["toxic"] for t, w in words.items() if t.startswith(term[:-1])), default=0)
            shorter = any(t.endswith(b"*") and term.startswith(t[:-1]) for t, _ in taken)
            longer_same = any(bytes(x["term"]) != term and bytes(x["term"]).endswith(b"*") and bytes(x["term"]).startswith(term[:-1]) and x["toxic"] > 0.8 * r["toxic"] for x in rows)
            if inside > 0.8 * r["toxic"] or shorter or (longer_same and len(term) - 1 < STEMS[0]):
                continue
        elif any(t.endswith(b"*") and term.startswith(t[:-1]) for t, _ in taken):
            continue
        taken.append((term, float(np.log((r["toxic"] + 0.5) / n_toxic) - np.log((r["clean"] + 0.5) / n_clean))))
    exact = [(t, w) for t, w in taken if not t.endswith(b"*")]
    stems = [(t[:-1], w) for t, w in taken if t.endswith(b"*")]
    return Lexicon([t.decode("latin-1") for t, _ in exact], [t.decode("latin-1") for t, _ in stems], [w for _, w in exact + stems])


def hit_features(docs: DataFrame, lexicon: Lexicon, window: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the ``FEATURES`` of every whole text.

    A hit counts as quoted if there is a quotation mark within ``window`` bytes before it and
    another within ``window`` bytes after it, in the same text. ``near_another`` counts hits
    with a second hit in that window; ``weight`` sums the lexicon weights of unquoted hits.
    """
    spark = docs.sparkSession
    automaton = compile_portions([t.encode("latin-1") for t in lexicon.terms], [t.encode("latin-1") for t in lexicon.stems])
    shared = spark.sparkContext.broadcast((automaton, np.array([*lexicon.weights, 0.0])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, weights = shared.value
        for batch in batches:
            for first, raw, offs in slices(batch.column(1)):
                data = plain(raw)
                starts, ends, row = letter_words(data, offs)
                _, at, where = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                term, kind = machine.read(data, starts[at], ends[at])
                term, kind = term[where], kind[where]
                hit = np.flatnonzero(term >= 0)
                a, b, row, kind, weight = starts[hit], ends[hit], row[hit], kind[hit], weights[term[hit]]
                marks = np.concatenate(([0], np.cumsum(data == 34)))
                left, right = np.maximum(a - window, offs[row]), np.minimum(b + window, offs[row + 1])
                quoted = (marks[a] > marks[left]) & (marks[right] > marks[b])
                near = np.searchsorted(a, right, "left") - np.searchsorted(b, left, "right") > 1
                n = len(offs) - 1
                columns = []
                for k in (EXACT, TYPO, STEM):
                    for q in (False, True):
                        columns.append(np.bincount(row[(kind == k) & (quoted == q)], minlength=n).astype(float))
                columns.append(np.bincount(row[near], minlength=n).astype(float))
                columns.append(np.bincount(row[~quoted], weight[~quoted], n).astype(float))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *(pa.array(c) for c in columns)], names=["key", *FEATURES])

    schema = "key long, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col(key).cast("long").alias("key"), text).mapInArrow(trimmed(run), schema).withColumnRenamed("key", key)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one the intercept) of a logistic regression, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        change = np.linalg.solve(curve, slope)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w


def score_toxicity(
    docs: DataFrame, labels: DataFrame, most_labels: int = 20_000, window: int = 80,
    key: str = "doc_id", text: str = "text", toxic: str = "toxic",
) -> DataFrame:
    """``key, score, predicted`` and the features for every document.

    Lexicon and weights are learnt from at most ``most_labels`` rows of ``labels`` (those with
    the smallest hash of their id); only texts enter a score. Without labels of both kinds
    every score is the share of toxic labels, or 0. A null or empty text has no hits and gets
    the score of a text without hits. Ids may repeat or be null; an empty table gives no rows.
    """
    ids, flag = bounded_labels(labels, toxic, most_labels, key)
    both = len(ids) > 0 and 0 < (flag > 0).sum() < len(flag)
    lexicon = learn_lexicon(docs, ids, flag, key=key, text=text) if both else Lexicon([], [], [])
    found = settle(hit_features(docs, lexicon, window, key, text))
    x = [F.log1p(F.greatest(F.col(f), F.lit(0.0))) for f in FEATURES]
    if both:
        sample = found.sparkSession.sparkContext.broadcast(ids)

        @F.pandas_udf("boolean")
        def known(values: pd.Series) -> pd.Series:
            return pd.Series(find(sample.value, values.fillna(-1).to_numpy(np.int64))[1], index=values.index)

        got = found.where(known(F.col(key))).dropDuplicates([key]).toPandas()  # at most the sample
        y = (flag[find(ids, got[key].to_numpy(np.int64))[0]] > 0).astype(float)
        w = fit_logistic(np.log1p(np.maximum(got[list(FEATURES)].to_numpy(), 0)), y)
    else:
        rate = float((flag > 0).mean()) if len(flag) else 0.0
        w = np.append(np.zeros(len(FEATURES)), np.log(rate / (1 - rate)) if 0 < rate < 1 else 30.0 if rate else -30.0)
    z = F.lit(float(w[-1]))
    for value, column in zip(w[:-1], x, strict=True):
        z = z + F.lit(float(value)) * column
    return found.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select(key, "score", "predicted", *FEATURES)
