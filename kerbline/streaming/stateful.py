"""Stream form of the order-dependent operators.

Rows of a key are buffered and released in time order once the watermark has passed them, so
out-of-order arrival and the split into micro-batches do not change the result. The same
step functions as in batch make the decisions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kerbline.operators.sequential import _plain
from kerbline.operators.steps import Step

NS_PER_MS = 1_000_000
RELEASE_MS = 1000  # timers lie on whole seconds, so a key has few of them


class OrderedStep(StatefulProcessor):
    """Buffer rows per key, run a step over them in time order as the watermark passes."""

    def __init__(self, step: Step, by: list[str], order: list[str], columns: list[str], added: list[str]):
        self.step, self.by, self.order = step, by, order
        self.columns, self.added = columns, added

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "row string")
        self.state = handle.getValueState("state", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting = set(self.handle.listTimers())
        place = self.columns.index(self.order[0])
        for pdf in rows:
            for record in pdf[self.columns].itertuples(index=False):
                values = [_plain(v) for v in record]
                self.buffer.appendValue((json.dumps(values),))
                due = (values[place] // NS_PER_MS // RELEASE_MS + 1) * RELEASE_MS
                if due not in waiting:
                    self.handle.registerTimer(due)
                    waiting.add(due)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # the first timer of a batch releases everything behind the watermark, the others find nothing left
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * NS_PER_MS
        places = [self.columns.index(c) for c in self.order]
        rows = [json.loads(r[0]) for r in self.buffer.get()]
        rows.sort(key=lambda r: [r[p] for p in places])
        ready = [r for r in rows if r[places[0]] < limit]
        if not ready:
            yield pd.DataFrame()
            return
        saved = self.state.get() if self.state.exists() else None
        state = json.loads(saved[0]) if saved else None
        inputs = [self.columns.index(c) for c in self.step.inputs]
        out = []
        for row in ready:
            state, values = self.step.advance(state, tuple(row[i] for i in inputs))
            if values is not None:
                out.append([*row, *values])
        self.state.update((json.dumps(state),))
        later = [(json.dumps(r),) for r in rows[len(ready):]]
        if later:
            self.buffer.put(later)
        else:
            self.buffer.clear()
        yield pd.DataFrame(out, columns=[*self.columns, *self.added])

    def close(self) -> None:
        pass


class VoxelLife(StatefulProcessor):
    """The latest point of a voxel, and a timer at the end of its life."""

    def __init__(self, keys: list[str], values: list[str], ttl_ns: int, time: str):
        self.keys, self.values, self.ttl_ns, self.time = keys, values, ttl_ns, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "t long, row string")

    def _due(self, t: int) -> int:
        return -(-(t + self.ttl_ns) // NS_PER_MS)

    def _row(self, key, values: list, gone: bool) -> pd.DataFrame:
        return pd.DataFrame([[*key, *values, gone]], columns=[*self.keys, *self.values, "gone"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.latest.get() if self.latest.exists() else None
        newest = None
        for pdf in rows:
            best = pdf.loc[pdf[self.time].idxmax()]
            if newest is None or best[self.time] > newest[self.time]:
                newest = best
        if newest is None or (held is not None and newest[self.time] < held[0]):
            yield pd.DataFrame()
            return
        values = [_plain(newest[c]) for c in self.values]
        t = int(newest[self.time])
        if held is not None and self._due(held[0]) != self._due(t):
            self.handle.deleteTimer(self._due(held[0]))
        self.latest.update((t, json.dumps(values)))
        self.handle.registerTimer(self._due(t))
        yield self._row(key, values, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.latest.get() if self.latest.exists() else None
        if held is None or self._due(held[0]) > expiredTimerInfo.getExpiryTimeInMs():
            yield pd.DataFrame()
            return
        self.latest.clear()
        yield self._row(key, json.loads(held[1]), True)

    def close(self) -> None:
        pass


def stream_sequential(stream: DataFrame, by: list[str], order: list[str], step: Step, event_time: str,
                      delay: str | None = None) -> DataFrame:
    """Apply ``step`` to a stream; needs the RocksDB state store provider.

    ``event_time`` is a TIMESTAMP column for the watermark and is not part of the output. Give
    ``delay`` only when the stream has no watermark yet.
    """
    columns = [c for c in stream.columns if c != event_time]
    added = T.StructType.fromDDL(step.outputs) if step.outputs else T.StructType()
    schema = T.StructType([stream.schema[c] for c in columns] + added.fields)
    marked = stream.withWatermark(event_time, delay) if delay else stream
    return (
        marked.groupBy(*by)
        .transformWithStateInPandas(
            OrderedStep(step, by, order, columns, added.fieldNames()),
            outputStructType=schema,
            outputMode="append",
            timeMode="eventTime",
        )
    )
