"""A data source for camera sidecars: very many small JSON files, read many to a task.

Spark's own JSON reader counts each file as four megabytes, so a task holds a few dozen. Here a
task reads some thousands. Filters on session, camera and time reach the source: the first
leaves out files before anything is opened, the others leave out rows as they are read.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual,
)

SUFFIX = ".meta.json"
#: Column, its Arrow type, and where its value stands in a sidecar.
FIELDS = (
    ("t_ns", pa.int64(), ("timestamp_ns",)), ("lat", pa.float64(), ("gps", "lat")), ("lon", pa.float64(), ("gps", "lon")),
    ("x", pa.float64(), ("bng", "x")), ("y", pa.float64(), ("bng", "y")), ("heading_deg", pa.float64(), ("heading_deg",)),
    ("heading_source", pa.string(), ("heading_source",)), ("gnss_fix_status", pa.int32(), ("gnss_fix_status",)),
    ("rig_id", pa.string(), ("rig_id",)), ("min_temp_c", pa.float64(), ("min_temp_c",)), ("max_temp_c", pa.float64(), ("max_temp_c",)),
    ("mean_temp_c", pa.float64(), ("mean_temp_c",)), ("radiometric", pa.string(), ("radiometric",)),
)
PLACE = ("session_id", "camera", "frame_id")
ARROW = pa.schema([*[(n, pa.string()) for n in PLACE], *[(n, k) for n, k, _ in FIELDS], ("path", pa.string())])
DDL = {pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.string(): "string"}
ROWS = 4096


@dataclass
class Files(InputPartition):
    paths: list[str]


def _place(path: str) -> tuple[str | None, str | None, str]:
    """Session, camera and frame from ``.../session/camera/frame.meta.json``."""
    parts = path.split("/")
    return (parts[-3] if len(parts) > 2 else None), (parts[-2] if len(parts) > 1 else None), parts[-1][: -len(SUFFIX)]


def _value(record: object, place: tuple[str, ...], kind: pa.DataType):
    for name in place:
        record = record.get(name) if isinstance(record, dict) else None
    if record is None or isinstance(record, (dict, list)):
        return None
    try:
        if pa.types.is_string(kind):
            return record if isinstance(record, str) else json.dumps(record)
        return int(record) if pa.types.is_integer(kind) else float(record)
    except (TypeError, ValueError):
        return None


class SidecarReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.files_per_task = int(options.get("filesPerTask", 5000))
        self.wanted: dict[str, set[str]] = {}
        self.since, self.until = -(2**63), 2**63 - 1
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in ("session_id", "camera") and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            elif name in ("session_id", "camera", "t_ns") and isinstance(f, IsNotNull):
                self.present.add(name)
            elif name == "t_ns" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.since = max(self.since, f.value + isinstance(f, GreaterThan))
            elif name == "t_ns" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.until = min(self.until, f.value - isinstance(f, LessThan))
            elif name == "t_ns" and isinstance(f, EqualTo):
                self.since, self.until = max(self.since, f.value), min(self.until, f.value)
            else:
                yield f

    @property
    def timed(self) -> bool:
        return (self.since, self.until) != (-(2**63), 2**63 - 1)

    def _list(self) -> Iterator[str]:
        fixed = self.path.split("*")[0].split("?")[0].split("[")[0]
        root = fixed if fixed == self.path else fixed.rsplit("/", 1)[0]
        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))
        pattern = None if fixed == self.path else self.path.split("://")[-1].removeprefix("file:")
        pending = [base.rstrip("/")]
        while pending:
            for info in store.get_file_info(fs.FileSelector(pending.pop())):
                if info.type == fs.FileType.Directory:
                    pending.append(info.path)
                elif info.path.endswith(SUFFIX) and (pattern is None or fnmatch.fnmatch("/" + info.path.lstrip("/"), "/" + pattern.lstrip("/"))):
                    if "session_id" not in self.wanted or _place(info.path)[0] in self.wanted["session_id"]:
                        yield info.path

    def partitions(self) -> list[Files]:
        paths = sorted(self._list())
        return [Files(paths[i : i + self.files_per_task]) for i in range(0, len(paths), self.files_per_task)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(self.path.split("*")[0])[0] if "://" in self.path else fs.LocalFileSystem()
        rows: list[tuple] = []
        for path in partition.paths:
            with store.open_input_stream(path) as stream:
                try:
                    record = json.loads(stream.read())
                except ValueError:  # cut off or not JSON: a row with its place only
                    record = {}
            session, camera, frame = _place(path)
            named = record.get("camera") if isinstance(record, dict) else None
            values = [_value(record, place, kind) for _, kind, place in FIELDS]
            camera = camera if named is None else str(named)
            if "camera" in self.wanted and camera not in self.wanted["camera"]:
                continue
            if self.timed and (values[0] is None or not self.since <= values[0] <= self.until):
                continue
            if any({"session_id": session, "camera": camera, "t_ns": values[0]}[c] is None for c in self.present):
                continue
            rows.append((session, camera, frame, *values, path))
            if len(rows) == ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class SidecarSource(DataSource):
    """``spark.read.format("sidecars").load(folder or pattern)``; option ``filesPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "sidecars"

    def schema(self) -> str:
        return ", ".join(f"{f.name} {DDL[f.type]}" for f in ARROW)

    def reader(self, schema) -> DataSourceReader:
        return SidecarReader(self.options)
