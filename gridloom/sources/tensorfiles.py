"""Dense day tensors on disk and their sidecars (SNK-4..8, SRC-12..15, VAL-5).

A tensor file holds one day as row-major float32 ``[T, G, F]`` without header, named
``<yyyyMMdd>.bin``.  Both directions work in ranges of steps: a day is written as tiles of at
most ``tile_steps`` steps by the tasks that hold them, and published only when all its tiles are
there; it is read as byte ranges, one row per (date, step) with the values still packed
(``tensorsource``).  No task holds a day and nothing passes through the driver.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import timeaxis as tx
from gridloom.operators.scan import prefix_sums
from gridloom.operators.tensors import unpack_steps
from gridloom.sources import tensorsource
from gridloom.sources.storage import filesystem, qualified

TILE_BYTES = 64 << 20
_COPY = 8 << 20


_TILE = pa.schema([("date", pa.date32()), ("tile", pa.int64()), ("steps", pa.int64()), ("rows", pa.int64()),
                   ("cells", pa.int64()), ("nodes", pa.int64()), ("node_sum", pa.int64()), ("whole", pa.bool_()), ("path", pa.string())])
_TILE_DDL = "date date, tile long, steps long, rows long, cells long, nodes long, node_sum long, whole boolean, path string"


class _TileWriter:
    """Rows of one (day, tile) in (step, node) order, written step by step while each step is a whole grid.

    The file appears under its final name only when the tile is closed, so a task that dies or
    is run twice leaves no partial tile behind.
    """

    def __init__(self, folder: str, day, tile: int, grids: int, n_features: int):
        self.fs, root = filesystem(folder)
        self.day, self.tile, self.grids = day, tile, grids
        self.folder = f"{root}/{day:%Y%m%d}"
        self.path = f"{self.folder}/{tile:06d}.tile"
        self.pending = f"{self.path}.{uuid.uuid4().hex}"
        self.rows = self.cells = 0
        self.steps: set[int] = set()
        self.nodes: set[int] = set()
        self.node_sum: int | None = None
        self.whole = True
        self.step, self.step_nodes, self.values = None, [], []
        self.out = None

    def add(self, step: int | None, nodes: list, values: np.ndarray) -> None:
        """Rows of one step (part of it, maybe), nodes ascending and values ``[rows, F]``."""
        if step != self.step:
            self._end_step()
            self.step = step
        self.rows += len(nodes)
        self.step_nodes += nodes
        if len(self.step_nodes) <= self.grids:
            self.values.append(values)
        else:  # too many rows for a grid: counted on, not kept
            self.whole, self.values = False, []
            self.nodes.update(n for n in self.step_nodes[:self.grids + 1] if n is not None)
            self.step_nodes = self.step_nodes[-1:] * (self.grids + 1)

    def _end_step(self) -> None:
        if self.step_nodes:
            distinct = {n for n in self.step_nodes if n is not None}
            if self.step is not None:
                self.steps.add(self.step)
                self.cells += len(distinct)
            self.nodes |= distinct if len(self.nodes) <= self.grids else set()
            check = zlib.crc32(np.array(sorted(distinct), np.int64).tobytes())
            self.node_sum = check if self.node_sum is None else self.node_sum if self.node_sum == check else -1
            self.whole &= self.step is not None and len(distinct) == len(self.step_nodes) == self.grids
            if self.whole:
                if self.out is None:
                    self.fs.create_dir(self.folder, recursive=True)
                    self.out = self.fs.open_output_stream(self.pending)
                self.out.write(np.concatenate(self.values).astype(np.float32).tobytes())
        self.step_nodes, self.values = [], []

    def close(self) -> dict:
        self._end_step()
        if self.out is not None:
            self.out.close()
            if self.whole:
                self.fs.move(self.pending, self.path)
            else:
                self.fs.delete_file(self.pending)
        return {"date": self.day, "tile": self.tile, "steps": len(self.steps), "rows": self.rows, "cells": self.cells,
                "nodes": len(self.nodes), "node_sum": self.node_sum, "whole": self.whole, "path": self.path if self.whole else None}


def _write_tiles(folder: str, grids: int, n_features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, done = None, []
        for batch in batches:
            days, tiles, steps, nodes = (batch.column(k).to_pylist() for k in range(4))
            values = np.column_stack([batch.column(4 + k).to_numpy(zero_copy_only=False).astype(np.float32) for k in range(n_features)])
            start = 0
            for i in range(1, len(days) + 1):
                if i < len(days) and (days[i], tiles[i], steps[i]) == (days[start], tiles[start], steps[start]):
                    continue
                if tile is None or (tile.day, tile.tile) != (days[start], tiles[start]):
                    if tile is not None:
                        done.append(tile.close())
                    tile = _TileWriter(folder, days[start], tiles[start], grids, n_features)
                tile.add(steps[start], nodes[start:i], values[start:i])
                start = i
        if tile is not None:
            done.append(tile.close())
        yield pa.RecordBatch.from_pylist(done, _TILE)
    return run


def _publish(folder: str, expected_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                name = f"{row['date']:%Y%m%d}.bin"
                row["file_name"] = name
                if row["reason"] is None:
                    pending = f"{root}/_tiles/{name}.{uuid.uuid4().hex}"
                    with fs.open_output_stream(pending) as out:
                        for path in row["paths"]:
                            with fs.open_input_stream(path) as tile:
                                while chunk := tile.read(_COPY):
                                    out.write(chunk)
                    size = fs.get_file_info(pending).size
                    if size != expected_bytes:
                        raise OSError(f"{name}: {size} bytes of {expected_bytes}")
                    fs.move(pending, f"{root}/{name}")
            yield pa.RecordBatch.from_pylist(
                [{"date": r["date"], "file_name": r["file_name"], "status": "success" if r["reason"] is None else "error",
                  "reason": r["reason"]} for r in rows],
                pa.schema([("date", pa.date32()), ("file_name", pa.string()), ("status", pa.string()), ("reason", pa.string())]))
    return run


def write_tensor_days(df: DataFrame, folder: str, steps: int, grids: int, features: list[str],
                      day: str = "date", step: str = "step", node: str = "grid_id", tile_steps: int | None = None) -> DataFrame:
    """SNK-4 (TNS-2 per day): long rows → one ``<yyyyMMdd>.bin`` per day; returns a per-day status.

    Rows are dealt once, by (day, tile of ``tile_steps`` steps), and sorted by (step, node); a task
    streams them into tile files step by step and checks on the way that every step is a whole grid
    of distinct nodes (VAL-1/VAL-2).  Each tile reports its counts; a day is published, by joining its
    tiles in order under a temporary name that is then moved, only when all T steps came with the
    same G nodes.  Any other day gets status ``error`` with the reason and no file.  Tasks may fail
    or run twice: tiles and days appear whole or not at all.  A day without a date has no file.
    """
    spark = df.sparkSession
    root = qualified(spark, folder)
    tile_steps = tile_steps or max(1, min(steps, TILE_BYTES // (grids * len(features) * 4)))
    tiles = f"{root}/_tiles/{uuid.uuid4().hex[:12]}"
    rows = df.where(F.col(day).isNotNull()).select(
        F.col(day).alias("date"), F.floor(F.coalesce(F.col(step), F.lit(0)) / tile_steps).cast("long").alias("tile"),
        F.col(step).cast("long").alias("step"), F.col(node).cast("long").alias("node"),
        *[F.col(c).cast("float").alias(f"f{i}") for i, c in enumerate(features)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = (rows.repartition(parts, "date", "tile").sortWithinPartitions("date", "tile", "step", "node")
               .mapInArrow(_write_tiles(tiles, grids, len(features)), _TILE_DDL))
    expected = steps * grids
    per_day = written.groupBy("date").agg(
        F.sum("rows").alias("rows"), F.sum("cells").alias("cells"), F.sum("steps").alias("steps"), F.max("nodes").alias("nodes"),
        ((F.count_distinct("node_sum") > 1) | (F.min("node_sum") < 0)).alias("uneven"), F.bool_and("whole").alias("whole"),
        F.transform(F.array_sort(F.collect_list(F.struct("tile", "path"))), lambda t: t["path"]).alias("paths"))
    reason = (F.when(F.col("rows") != expected, F.format_string(f"expected {expected} rows, got %d", F.col("rows")))
              .when(F.col("cells") != expected, F.format_string(f"expected {expected} distinct cells, got %d", F.col("cells")))
              .when(F.col("steps") != steps, F.format_string(f"expected {steps} steps, got %d", F.col("steps")))
              .when(F.col("uneven") | ~F.col("whole"), F.lit(f"steps do not share {grids} nodes")))
    return (per_day.select("date", reason.alias("reason"), "paths")
            .mapInArrow(_publish(root, expected * len(features) * 4), "date date, file_name string, status string, reason string"))


def read_tensor_steps(spark: SparkSession, folder: str, steps: int, grids: int, n_features: int, first_day: str | None = None,
                      last_day: str | None = None, first_step: int = 0, last_step: int | None = None) -> DataFrame:
    """SRC-13: one row per (date, step) with its values packed, read as byte ranges; bounds are inclusive.

    Files of another size than a whole day are not read (``tensor_files`` reports them).
    """
    tensorsource.register(spark)
    reader = (spark.read.format(tensorsource.FORMAT).option("path", qualified(spark, folder)).option("steps", steps)
              .option("grids", grids).option("features", n_features).option("first_step", first_step)
              .option("last_step", steps - 1 if last_step is None else last_step))
    for name, value in (("first_day", first_day), ("last_day", last_day)):
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load()


def tensor_files(spark: SparkSession, folder: str, steps: int, grids: int, n_features: int) -> DataFrame:
    """Per ``*.bin`` file: name, length and whether it is a whole day (file listing only, no content)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    expected = steps * grids * n_features * 4
    return files.select(F.regexp_extract("path", r"([^/]+)\.bin$", 1).alias("stem"), "length",
                        F.when(F.col("length") == expected, F.lit("success")).otherwise(F.lit("error")).alias("status"))


def read_tensor_days(spark: SparkSession, folder: str, steps: int, grids: int, n_features: int,
                     require_any: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC-13 in long form: (date, step, node, feature, value) rows of all whole days, and the file report.

    With ``require_any`` a folder without a single whole file is an error (checked on the listing).
    """
    report = tensor_files(spark, folder, steps, grids, n_features)
    if require_any and report.filter(F.col("status") == "success").isEmpty():
        raise ValueError(f"no valid tensor file of {steps * grids * n_features * 4} bytes in {folder}")
    packed = read_tensor_steps(spark, folder, steps, grids, n_features)
    long = unpack_steps(packed, ["date", "step"], "features", "node", "feature", "value")
    return long.select("date", "step", F.col("node").cast("long").alias("node"), F.col("feature").cast("long").alias("feature"),
                       "value"), report


def write_sidecars(spark: SparkSession, folder: str, long_times: DataFrame, coords: DataFrame,
                   metadata: dict, day: str = "date", ts: str = "ts", elevation: DataFrame | None = None) -> None:
    """SNK-5 metadata (one JSON row), SNK-6 time index (one ``{day: [times]}`` line per day), SNK-7 coords, elevation.

    The time index is written as JSON lines, each a one-day map, so no task holds the whole index.
    ``elevation`` has (grid_id, elevation).
    """
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{folder}/metadata")
    per_day = long_times.groupBy(day).agg(F.array_sort(F.collect_set(tx.ntz_text(ts))).alias("t"))
    per_day.select(F.to_json(F.create_map(F.date_format(day, "yyyyMMdd"), F.col("t"))).alias("value")) \
        .write.mode("overwrite").text(f"{folder}/time_index")
    coords.write.mode("overwrite").parquet(f"{folder}/coords")
    if elevation is not None:
        elevation.select("grid_id", F.col("elevation").cast("float").alias("elevation")).write.mode("overwrite").parquet(f"{folder}/elevation")


def read_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-15: (node, lon, lat, elevation) of the nodes in tensor order, from the sidecars.

    ``node`` is the position in the tensor, the rank of the grid id; elevation is null where the
    sidecar is absent or does not know the id.
    """
    coords = spark.read.parquet(f"{folder}/coords").select("grid_id", "lon", "lat")
    fs, root = filesystem(qualified(spark, folder))
    import pyarrow.fs as pafs
    if fs.get_file_info(f"{root}/elevation").type == pafs.FileType.Directory:
        coords = coords.join(spark.read.parquet(f"{folder}/elevation"), "grid_id", "left")
    else:
        coords = coords.withColumn("elevation", F.lit(None).cast("float"))
    ranked = prefix_sums(coords.withColumn("__one", F.lit(1)), ["grid_id"], "__one", "node")
    return ranked.select("node", "grid_id", "lon", "lat", "elevation")


def read_time_index(spark: SparkSession, path: str) -> DataFrame:
    """SRC-14: day → list of timestamps, as (date, step, ts); one map document per line."""
    docs = spark.read.text(path).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    days = docs.select(F.explode("m").alias("stem", "times"))
    return days.select(F.to_date("stem", "yyyyMMdd").alias("date"),
                       F.posexplode("times").alias("step", "ts_text")) \
               .select("date", F.col("step").cast("bigint").alias("step"),
                       F.to_timestamp_ntz("ts_text", F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"))


def read_metadata(spark: SparkSession, path: str) -> dict:
    """SRC-15: the metadata sidecar (a few hundred bytes) as a dict."""
    return json.loads(spark.read.text(path).first()[0])


def round_trip_equal(written: DataFrame, read_back: DataFrame, keys: list[str], value: str) -> DataFrame:
    """VAL-5: count and order-free hash of (keys, value) on both sides; one row with ``equal``."""
    def digest(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64(*keys, F.col(value).cast("float")).cast("decimal(38,0)")).alias("h"))
    back = digest(read_back)
    one = digest(written).select(F.col("n").alias("rows_written"), F.col("h").alias("hash_written")).withColumns(
        {"rows_read": back.select("n").scalar(), "hash_read": back.select("h").scalar()})
    return one.withColumn("equal", (F.col("rows_written") == F.col("rows_read")) & F.col("hash_written").eqNullSafe(F.col("hash_read")))
