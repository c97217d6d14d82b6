"""Landed response pages as a Python Data Source that plans its own partitions.

A collector lands response bodies in files: a body per line, or a body per file. The
source lists the files, cuts them into partitions of bounded size (long files of lines
at byte ranges), and leaves out files that a filter on ``path`` or ``landed_at`` rules
out before any partition is planned. As a stream it takes what landed since the offset,
which is the time and the path of the last file. Tasks hand over Arrow batches; what is
in the bodies is left to Spark's own functions (``envelopes.unwrap_responses``).

Only the driver lists, and only names, sizes and times; bodies are read in tasks. Any
store that ``pyarrow.fs`` knows by its address will do.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual, StringStartsWith,
)

# the source runs in workers that have no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "landed"
SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("landed_at", T.TimestampType()),
     T.StructField("position", T.LongType()), T.StructField("body", T.StringType())]
)
_ARROW = {"path": pa.string(), "landed_at": pa.timestamp("us", "UTC"), "position": pa.int64(), "body": pa.string()}
PARTITION_BYTES = 64 << 20
FILE_BYTES = 1 << 20  # what opening a file counts as, so that a partition has not too many small ones
BATCH_BYTES = 4 << 20
SETTLED_S = 0


@dataclass(frozen=True)
class LandedFile:
    path: str
    size: int
    landed_ns: int

    @property
    def landed_at(self) -> dt.datetime:
        return dt.datetime.fromtimestamp(self.landed_ns // 1000 / 1e6, dt.UTC)


@dataclass
class Slices(InputPartition):
    """Byte ranges of files: (file, first byte, end)."""

    slices: list[tuple[LandedFile, int, int]]


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of an address and the path within it; an address without a scheme is a local path."""
    local = re.match(r"(?:file:/*)?(/.*)", "/" + path[5:].lstrip("/") if path.startswith("file:") else path)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(path)


def list_landed(path: str, glob: str) -> list[LandedFile]:
    """Files below ``path`` by name, without those that begin with "." or "_"; an absent folder has none."""
    store, base = file_system(path)
    found = store.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
    named = [f for f in found if f.type == pafs.FileType.File and f.base_name[:1] not in ("", ".", "_")]
    kept = [LandedFile(f.path, f.size, f.mtime_ns or 0) for f in named if fnmatch.fnmatchcase(f.base_name, glob)]
    return sorted(kept, key=lambda f: (f.landed_ns, f.path))


def plan_slices(files: Iterable[LandedFile], partition_bytes: int, lines: bool) -> list[Slices]:
    """Partitions of about ``partition_bytes``; files of lines are cut, others stay whole."""
    planned, now, size = [], [], 0
    for file in files:
        step = partition_bytes if lines else max(1, file.size)
        for first in range(0, max(1, file.size), step):
            end = min(first + step, file.size)
            cost = end - first + min(FILE_BYTES, partition_bytes // 4)
            if now and size + cost > partition_bytes:
                planned.append(Slices(now))
                now, size = [], 0
            now.append((file, first, end))
            size += cost
    return [*planned, Slices(now)] if now else planned


def _bodies(store: pafs.FileSystem, file: LandedFile, first: int, end: int, lines: bool) -> Iterator[tuple[int, bytes]]:
    """Places and bodies; of lines those that begin in the range, to their ends."""
    with store.open_input_file(file.path) as raw:
        if not lines:
            yield 0, raw.read()
            return
        # the line that holds the byte before the range is another range's
        at = max(0, first - 1)
        raw.seek(at)
        whole, rest, more = first == 0, b"", True
        while more and (at < end or not whole):
            cut = rest.find(b"\n")
            while cut < 0 and more:
                seen, read = len(rest), raw.read(BATCH_BYTES)
                more, rest = bool(read), rest + read
                cut = rest.find(b"\n", seen)
            line, rest, size = (rest, b"", len(rest)) if cut < 0 else (rest[:cut], rest[cut + 1 :], cut + 1)
            if whole and line.strip():
                yield at, line.removesuffix(b"\r")
            at, whole = at + size, True


class LandedReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.lines = options.get("bodies", "lines") == "lines"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.columns = schema.names
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes filters on what all bodies of a file have in common; the others stay with Spark."""
        for f in filters:
            if _of_file(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        files = [f for f in list_landed(self.path, self.glob) if all(_fits(f, x) for x in self.filters)]
        # Spark wants one partition at least
        return plan_slices(files, self.partition_bytes, self.lines) or [Slices([])]

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        return read_slices(partition, self.path, self.lines, self.columns)


class LandedStream(DataSourceStreamReader):
    """Offsets are the time and path of the last file that was taken."""

    def __init__(self, options: dict, schema: T.StructType):
        self.reader = LandedReader(options, schema)
        # a file counts as landed once it is so old, where files with an older time may still appear
        self.settled_ns = int(float(options.get("settledseconds", SETTLED_S)) * 1e9)

    def initialOffset(self) -> dict:
        return {"landed_ns": -1, "path": ""}

    def latestOffset(self) -> dict:
        now = dt.datetime.now(dt.UTC).timestamp() * 1e9
        files = list_landed(self.reader.path, self.reader.glob)
        landed = [f for f in files if not self.settled_ns or f.landed_ns <= now - self.settled_ns]
        return {"landed_ns": landed[-1].landed_ns, "path": landed[-1].path} if landed else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        after, last = ((o["landed_ns"], o["path"]) for o in (start, end))
        files = list_landed(self.reader.path, self.reader.glob)
        return plan_slices([f for f in files if after < (f.landed_ns, f.path) <= last], self.reader.partition_bytes, self.reader.lines)

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        return self.reader.read(partition)


class LandedBodies(DataSource):
    """Options: path, glob, bodies ("lines" or "files"), partitionBytes, settledSeconds (of a stream).

    A schema given by the caller names the columns to make; others are not made.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return SCHEMA

    def _checked(self, schema: T.StructType) -> T.StructType:
        known = {f.name: f.dataType for f in SCHEMA}
        if any(known.get(f.name) != f.dataType for f in schema):
            raise ValueError(f"columns are some of {SCHEMA.simpleString()}")
        if "path" not in self.options:
            raise ValueError("landed bodies need a path")
        return schema

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return LandedReader(self.options, self._checked(schema))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return LandedStream(self.options, self._checked(schema))


def read_slices(partition: Slices, path: str, lines: bool, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The bodies of a partition as Arrow batches of bounded size."""
    store, _ = file_system(path)
    kept: dict[str, list] = {c: [] for c in columns}
    held = size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kept[c], _ARROW[c]) for c in columns], names=list(columns))

    for file, first, end in partition.slices:
        for at, body in _bodies(store, file, first, end, lines):
            row = {"path": file.path, "landed_at": file.landed_at, "position": at, "body": body}
            for c in columns:
                kept[c].append(row[c].decode("utf-8", "replace") if c == "body" else row[c])
            held, size = held + 1, size + len(body)
            if size >= BATCH_BYTES or held >= 10_000:
                yield batch()
                kept, held, size = {c: [] for c in columns}, 0, 0
    if held:
        yield batch()


_COMPARED = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b, StringStartsWith: lambda a, b: a.startswith(b),
}


def _of_file(f: Filter) -> bool:
    return type(f) in _COMPARED and f.attribute in (("path",), ("landed_at",))


def _fits(file: LandedFile, f: Filter) -> bool:
    mine = getattr(file, f.attribute[0])
    return _COMPARED[type(f)](mine, _instant(f.value) if f.attribute == ("landed_at",) else f.value)


def _instant(value):
    if isinstance(value, (tuple, list)):
        return type(value)(_instant(v) for v in value)
    return value.replace(tzinfo=dt.UTC) if value.tzinfo is None else value


def _prepared(spark: SparkSession) -> SparkSession:
    """A session that knows the source and lets it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedBodies)
    return spark


def read_landed(spark: SparkSession, path: str, columns: Sequence[str] = tuple(SCHEMA.names), **options) -> DataFrame:
    """Landed bodies: path, landed_at, position (byte where a line begins) and body, or some of them."""
    schema = T.StructType([f for f in SCHEMA if f.name in columns])
    return _prepared(spark).read.format(NAME).schema(schema).options(path=path, **options).load()


def stream_landed(spark: SparkSession, path: str, columns: Sequence[str] = tuple(SCHEMA.names), **options) -> DataFrame:
    """The same as a stream of what lands."""
    schema = T.StructType([f for f in SCHEMA if f.name in columns])
    return _prepared(spark).readStream.format(NAME).schema(schema).options(path=path, **options).load()
