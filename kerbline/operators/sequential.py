"""Batch form of the order-dependent operators, parallel inside a key.

The next decision depends on earlier ones, so a key cannot simply be cut. The rows are put
in (key, time) order over all tasks by range partitioning and cut into segments of about
equal size, wherever the keys begin and end, so a key with a third of all rows spans a third
of the segments. The rows of one key in one segment are a part.

Every part keeps a table of the states it was entered with and left in, first for the empty
state. Each round composes the tables of a key from its first part on: where a part was never
entered with the state that reaches it, its exit is foretold, either as in an earlier run
(with the components carried on that the step names) or, where parts before did nothing to
the state, as untouched (``Step.idle``). Both foretold chains are run, all parts at once, and
added to the tables. The work is done when the chain meets no unknown entry: it is then exact.
A state that is forgotten, kept or shifted over any number of parts takes a few rounds. After
``rounds`` of them, about the logarithm of the number of segments, what a key still lacks is
walked in order in one pass that streams its rows.

Between rounds only one row per part and run travels. Rows and states are settled in the
cluster's shared checkpoint folder, which also fixes where the segments are cut.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.operators.ordered import match
from kerbline.operators.steps import Step
from kerbline.session import settle

SEG, ENTRY, EXIT, N = "__seg", "__entry", "__exit", "__n"
RUN, MAIN, KNOWN = "__run", "__main", "__known"
SEGMENT_ROWS = 50_000


def _plain(value):
    """Pandas scalars to plain Python, missing values to None."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


def _walk(step: Step, by: list[str], order: list[str], pdf: pd.DataFrame, entries: dict):
    """Run the step over the sorted rows of a segment, key by key.

    Returns the sorted frame, the emitted positions and values, and (exit state, rows) per key.
    """
    pdf = pdf.sort_values([*by, *order], kind="stable").reset_index(drop=True)
    keys = list(zip(*[[_plain(v) for v in pdf[c].tolist()] for c in by])) if by else [()] * len(pdf)
    inputs = zip(*[[_plain(v) for v in pdf[c].tolist()] for c in step.inputs])
    kept, values, exits = [], [], {}
    now, state, since = None, None, 0
    for i, (key, row) in enumerate(zip(keys, inputs)):
        if key != now or i == 0:
            if i:
                exits[now] = json.dumps(state), i - since
            entry = entries.get(key)
            now, state, since = key, json.loads(entry) if entry else None, i
        state, out = step.advance(state, row)
        if out is not None:
            kept.append(i)
            values.append(out)
    if len(pdf):
        exits[now] = json.dumps(state), len(pdf) - since
    return pdf, kept, values, exits


def _entries(states: pd.DataFrame, by: list[str]) -> dict:
    rows = zip(*[[_plain(v) for v in states[c].tolist()] for c in (*by, ENTRY)])
    return {tuple(r[:-1]): _text(r[-1]) for r in rows}


def _foretell(step: Step, entry: str | None, runs: list[tuple[str | None, str, int]], idle: bool) -> str:
    """The exit of a part for an entry that it was never run with; ``runs`` are its runs so far."""
    state = json.loads(entry) if entry else None
    before, after, n = runs[-1]
    if state is not None and (idle or _was_idle(step, before, after, n)):
        return json.dumps(step.idle(state, n))
    if state is None or before is None or not step.carried:
        return after
    old, new = json.loads(before), json.loads(after)
    if old is None or new is None:
        return after
    for i in step.carried:
        new[i] += state[i] - old[i]
    return json.dumps(new)


def _was_idle(step: Step, before: str | None, after: str, n: int) -> bool:
    state = json.loads(before) if before else None
    return state is not None and json.dumps(step.idle(state, n)) == after


def _compose(step: Step, parts: list[list[tuple[str | None, str, int]]]) -> list[tuple[int, str | None, bool, bool]]:
    """(part, entry, on the main chain, known) of the parts of a key in order.

    The main chain follows known runs exactly; from the first unknown entry on it goes by the
    part before it (untouched, if that part left the state untouched) or by each part's last
    run. The other chain takes the other choice.
    """
    out, entry, exact, idle, last = [], None, True, False, False
    other: str | None = None
    for i, runs in enumerate(parts):
        known = {b: a for b, a, _ in runs}
        if exact and entry not in known:
            exact, idle, other = False, last, entry
        if exact:
            out.append((i, entry, True, True))
            n = runs[0][2]
            last = _was_idle(step, entry, known[entry], n)
            entry = known[entry]
            continue
        out.append((i, entry, True, entry in known))
        if other != entry:
            out.append((i, other, False, other in known))
        entry = known[entry] if entry in known else _foretell(step, entry, runs, idle)
        other = known[other] if other in known else _foretell(step, other, runs, not idle)
    return out


def entry_states(narrow: DataFrame, by: list[str], order: list[str], step: Step, segments: int,
                 rounds: int | None = None) -> tuple[DataFrame, int]:
    """The state in which each part of ``narrow`` (rows with their segment) is entered, and the rounds taken."""
    key_fields = [narrow.schema[k] for k in by]
    text, long, flag = T.StringType(), T.LongType(), T.BooleanType()
    head = [T.StructField(SEG, T.IntegerType()), *key_fields, T.StructField(ENTRY, text)]
    ran = T.StructType([*head, T.StructField(EXIT, text), T.StructField(N, long), T.StructField(RUN, T.IntegerType())])
    placed = T.StructType([*head, T.StructField(MAIN, flag), T.StructField(KNOWN, flag)])

    def results(pdf: pd.DataFrame, entries: dict, number: int) -> list[tuple]:
        seg = pdf[SEG].iloc[0]
        *_, exits = _walk(step, by, order, pdf, entries)
        return [(seg, *key, entries.get(key), left, n, number) for key, (left, n) in exits.items()]

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(results(pdf, {}, 0), columns=ran.fieldNames())

    def runner(number: int):
        def again(pdf: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            done = []
            for _, some in asked.groupby(MAIN):  # one entry for each key at a time
                wanted = _entries(some, by)
                done += [r for r in results(pdf, wanted, number) if tuple(r[1 : 1 + len(by)]) in wanted]
            return pd.DataFrame(done, columns=ran.fieldNames())

        return again

    def compose(runs: pd.DataFrame) -> pd.DataFrame:
        runs = runs.sort_values([SEG, RUN], kind="stable")
        key = tuple(runs[c].iloc[0] for c in by)
        numbers, parts = [], []
        for seg, some in runs.groupby(SEG, sort=True):
            numbers.append(seg)
            parts.append([(_text(e), x, int(n)) for e, x, n in zip(some[ENTRY], some[EXIT], some[N])])
        rows = [(numbers[i], *key, entry, main, known) for i, entry, main, known in _compose(step, parts)]
        return pd.DataFrame(rows, columns=placed.fieldNames())

    limit = 1 + max(1, segments - 1).bit_length() if rounds is None else rounds
    tables = settle(narrow.groupBy(SEG).applyInPandas(first, ran))
    part = [SEG, *by]
    # a key inside one segment is entered with the empty state; only the others have anything to compose
    within = tables.groupBy(*by).agg(F.count(F.lit(1)).alias("__parts")).where("__parts = 1").drop("__parts")
    whole = match(tables, within, by, "left_semi").select(*part, ENTRY)
    tables = settle(match(tables, within, by, "left_anti")) if segments > 1 else tables
    for number in range(1, limit + 1):
        chain = settle(tables.groupBy(*by).applyInPandas(compose, placed))
        asked = chain.where(~F.col(KNOWN))
        if asked.isEmpty():
            known = chain.where(MAIN).select(*part, ENTRY)
            return (known if segments == 1 else settle(known.unionByName(whole))), number
        rows = match(narrow, asked.select(*part).distinct(), part, "left_semi")
        fresh = rows.groupBy(SEG).cogroup(asked.groupBy(SEG)).applyInPandas(runner(number), ran)
        tables = tables.unionByName(settle(fresh))
    chain = settle(tables.groupBy(*by).applyInPandas(compose, placed)).where(MAIN)
    front = chain.where(~F.col(KNOWN)).groupBy(*by).agg(F.min(SEG).alias("__from"))
    walked = _walk_on(narrow, chain, front, by, order, step, T.StructType(head))
    settled = match(chain.select(*part, ENTRY), front.select(*by), by, "left_anti") if by else chain.limit(0).select(*part, ENTRY)
    behind = match(chain.select(*part, ENTRY), front, by).where(F.col(SEG) < F.col("__from")).select(*part, ENTRY)
    return settle(whole.unionByName(settled).unionByName(behind).unionByName(walked)), limit + 1


def _walk_on(narrow: DataFrame, chain: DataFrame, front: DataFrame, by: list[str], order: list[str], step: Step,
             schema: T.StructType) -> DataFrame:
    """Entry states from each key's first unknown part on, by streaming its rows in order."""
    first = match(chain, front, by).where(F.col(SEG) == F.col("__from")).select(SEG, *by, ENTRY)
    rest = match(narrow, front, by).where(F.col(SEG) >= F.col("__from")).drop("__from")
    rows = match(rest, first, [SEG, *by], "left")
    spread = rows.repartition(*by) if by else rows.coalesce(1)
    columns = [SEG, *by]

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in frames:
            spots = list(zip(*[[_plain(v) for v in pdf[c].tolist()] for c in columns]))
            inputs = zip(*[[_plain(v) for v in pdf[c].tolist()] for c in step.inputs])
            out = []
            for spot, row, entry in zip(spots, inputs, pdf[ENTRY].tolist()):
                if now is None or spot[1:] != now[1:]:
                    state = json.loads(entry) if _text(entry) else None
                if spot != now:
                    now = spot
                    out.append((*spot, None if state is None else json.dumps(state)))
                state, _ = step.advance(state, row)
            yield pd.DataFrame(out, columns=schema.fieldNames())

    return spread.sortWithinPartitions(*by, *order).mapInPandas(walk, schema)


def run_sequential(df: DataFrame, by: list[str], order: list[str], step: Step,
                   segment_rows: int = SEGMENT_ROWS, rounds: int | None = None, segments: int | None = None) -> DataFrame:
    """Apply ``step`` to each key in ``order``; rows it emits keep their columns and gain its outputs.

    There is one segment per ``segment_rows`` rows, and at least as many as ``segments`` says:
    a task holds a whole segment, so their size must not grow with the table.
    """
    columns = list(df.columns)
    segments = max(segments or 1, -(-df.count() // segment_rows))
    data = settle(df.repartitionByRange(segments, *by, *order).withColumn(SEG, F.spark_partition_id()))
    narrow = data.select(SEG, *dict.fromkeys([*by, *order, *step.inputs]))
    known, _ = entry_states(narrow, by, order, step, segments, rounds)
    added = T.StructType.fromDDL(step.outputs) if step.outputs else T.StructType()
    new_columns = added.fieldNames()
    out_schema = T.StructType([*df.schema.fields, *added.fields])

    def emit(pdf: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        pdf, kept, values, _ = _walk(step, by, order, pdf, _entries(entries, by))
        out = pdf.iloc[kept][columns].reset_index(drop=True)
        for i, name in enumerate(new_columns):
            out[name] = pd.Series([v[i] for v in values], dtype=object)
        return out

    return data.groupBy(SEG).cogroup(known.groupBy(SEG)).applyInPandas(emit, out_schema)
