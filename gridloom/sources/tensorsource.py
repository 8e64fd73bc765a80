"""A Spark data source for day tensors: byte ranges of files as partitions (SRC-13).

``<yyyyMMdd>.bin`` holds one day as row-major float32 ``[T, G, F]``, so a step is a byte range
that is known without reading the file.  The source lists the folder, drops days and steps that
the options (or pushed filters on ``date`` and ``step``) exclude, and plans runs of consecutive
steps of at most ``partition_bytes`` as partitions.  A task seeks to its range and returns one
row per (date, step) with the values still packed, so neither a file nor a day is ever held
whole and reading one step of T costs a T-th of the bytes.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)

FORMAT = "gridloom_tensors"
SCHEMA = "date date, step bigint, features array<array<float>>"
_ARROW = pa.schema([("date", pa.date32()), ("step", pa.int64()), ("features", pa.list_(pa.list_(pa.float32())))])
_FAR = 1 << 62


@dataclass
class StepRange(InputPartition):
    """Steps ``first <= step < end`` of one day's file."""

    path: str
    day: dt.date
    first: int
    end: int


class _Bounds:
    """Inclusive bounds of a column, and the values it is limited to if there are any."""

    def __init__(self, low, high):
        self.low, self.high, self.values = low, high, None

    def add(self, f: Filter) -> bool:
        if isinstance(f, In):
            self.values = set(f.value) if self.values is None else self.values & set(f.value)
        elif isinstance(f, EqualTo):
            self.values = {f.value} if self.values is None else self.values & {f.value}
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, f.value)
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            self.high = min(self.high, f.value)
        else:
            return False
        return True

    def admits(self, value) -> bool:
        return self.low <= value <= self.high and (self.values is None or value in self.values)


def _as_day(text: str | None, default: dt.date) -> dt.date:
    return dt.date.fromisoformat(text) if text else default


class TensorReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.steps, self.grids, self.features = (int(options[k]) for k in ("steps", "grids", "features"))
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.dates = _Bounds(_as_day(options.get("first_day"), dt.date.min), _as_day(options.get("last_day"), dt.date.max))
        self.wanted = _Bounds(int(options.get("first_step", 0)), int(options.get("last_step", _FAR)))

    @property
    def step_bytes(self) -> int:
        return self.grids * self.features * 4

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of ``date`` and ``step`` prune files and byte ranges; Spark applies every filter again."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("date",):
                self.dates.add(f)
            elif column == ("step",):
                self.wanted.add(f)
            yield f

    def partitions(self) -> list[StepRange]:
        from gridloom.sources.storage import filesystem

        fs, root = filesystem(self.folder)
        import pyarrow.fs as pafs
        run = max(1, self.partition_bytes // self.step_bytes)
        out = []
        for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda i: i.path):
            stem = re.search(r"(\d{8})\.bin$", info.path)
            if not stem or info.size != self.steps * self.step_bytes:
                continue
            try:
                day = dt.datetime.strptime(stem[1], "%Y%m%d").date()
            except ValueError:
                continue
            if not self.dates.admits(day):
                continue
            first = None
            for step in range(self.steps + 1):  # runs of wanted steps, cut at the partition size
                wanted = step < self.steps and self.wanted.admits(step)
                if first is not None and (not wanted or step - first == run):
                    out.append(StepRange(info.path, day, first, step))
                    first = None
                if wanted and first is None:
                    first = step
        return out

    def read(self, partition: StepRange | None) -> Iterator[pa.RecordBatch]:
        from gridloom.sources.storage import filesystem

        if partition is None:  # Spark's one partition where none is planned
            return
        fs, _ = filesystem(self.folder)
        node_ends = np.arange(0, self.grids * self.features + 1, self.features, dtype=np.int32)
        with fs.open_input_file(partition.path) as f:
            f.seek(partition.first * self.step_bytes)
            for step in range(partition.first, partition.end):
                values = np.frombuffer(f.read(self.step_bytes), np.float32)
                # NaN marks a missing value inside a float tensor; NULL is the missing value of a table
                nodes = pa.ListArray.from_arrays(pa.array(node_ends), pa.array(values, mask=np.isnan(values)))
                packed = pa.ListArray.from_arrays(pa.array([0, self.grids], pa.int32()), nodes)
                yield pa.RecordBatch.from_arrays([pa.array([partition.day]), pa.array([step], pa.int64()), packed], schema=_ARROW)


class TensorSource(DataSource):
    """``spark.read.format("gridloom_tensors")`` with options path, steps, grids, features and optional bounds."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TensorReader:
        return TensorReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known; its reader takes filters, which Spark offers to Python sources on request only."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TensorSource)
