"""Incremental ingest with Structured Streaming (STM-1, STM-2).

The file source's checkpoint is the record of which files were already taken
(the "which pages do I have" question of a resumable download), the watermark
bounds the state, and ``upserts.run_updates`` processes what is there and stops,
so the same code serves a scheduled batch and a continuous stream.  State and
output live under the shared checkpoint folder; a restarted query resumes from
its checkpoint after executor or driver loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridloom.functions import timeaxis as tx
from gridloom.operators import quality
from gridloom.streaming.upserts import latest


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over a folder, or over one file given by its path."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    p = PurePosixPath(path)
    if p.suffix:  # a single file: stream its folder, filtered to that name
        return reader.option("pathGlobFilter", p.name).load(str(p.parent))
    return reader.load(path)


def event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Watermarks need ``timestamp``; batch data are ``timestamp_ntz``.

    The wall clock is mapped to the same instant in UTC whatever the session time
    zone, so event-time windows start at wall-clock midnight.
    """
    return df.withColumn(out, F.timestamp_seconds(tx.epoch_seconds(ts)))


def wall_clock(instant: F.Column) -> F.Column:
    """Inverse of ``event_time``: a UTC instant back to a ``timestamp_ntz`` wall clock."""
    secs = F.unix_seconds(instant)
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.floor(secs / 86400).cast("int"), F.lit(0), F.lit(0),
                                 F.pmod(secs, F.lit(86400)).cast("decimal(18,6)")))


def keep_first_stream(stream: DataFrame, ts: str, keys: list[str], order: list[str], watermark: str) -> DataFrame:
    """STM-1: the first row in ``order`` of every (ts, keys), kept up to date as rows arrive, and the late rows.

    State is one table per (day, keys): the row that leads each of the day's times, at most T of
    them.  A trigger emits a row with ``late = 0`` when it takes the lead, so the latest version
    of every (ts, keys) equals the batch keep-first (WIN-1) however the rows were dealt over
    triggers.  A row whose time is older than the watermark takes no part; it is emitted with
    ``late = 1``.  The state of a day goes when the watermark passes its end.

    A stateful operator never sees the rows that are late by its watermark column.  So the
    watermark rides on a copy of every row's time, which is gone before the shuffle, and the rows
    themselves carry no event time.

    Run it in ``update`` mode (``upserts.run_updates``, partitioned by ``late``).  Rows without a
    time have no cell and are left out; ``pages.file_report`` counts them.
    """
    names = stream.columns
    s = event_time(stream.filter(F.col(ts).isNotNull()), ts)
    s = s.withColumns({"__day": F.to_date(ts), "__ms": F.unix_millis("event_time")})
    s = s.withColumn("event_time", F.explode(F.array(F.col("event_time"), F.lit(None).cast("timestamp"))))
    s = s.withWatermark("event_time", watermark).filter(F.col("event_time").isNull())
    out = T.StructType([*stream.schema.fields, T.StructField("late", T.IntegerType())])
    state = T.StructType([T.StructField("leaders", T.BinaryType())])

    def update(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        passed = held.getCurrentWatermarkMs()
        new = pd.concat(list(frames), ignore_index=True)
        late = new["__ms"] < passed
        rows = new.loc[~late, names].assign(__held=False)
        if held.exists and len(rows):
            old = pa.ipc.open_stream(held.get[0]).read_pandas()
            rows = pd.concat([old.assign(__held=True), rows], ignore_index=True)
        lead = rows.sort_values([ts, *order], kind="stable").drop_duplicates(ts)
        changed = lead.loc[~lead["__held"], names].assign(late=0)
        yield pd.concat([changed, new.loc[late, names].assign(late=1)], ignore_index=True) if late.any() else changed
        if len(lead):
            table = pa.Table.from_pandas(lead[names], preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            held.update((sink.getvalue().to_pybytes(),))
        if held.exists:  # a call clears the timeout, so it is set again even if all rows were late
            day_end = int(pd.Timestamp(key[0]).timestamp() * 1000) + 86_400_000
            if day_end > passed:
                held.setTimeoutTimestamp(day_end)
            else:
                held.remove()

    return s.groupBy("__day", *keys).applyInPandasWithState(update, out, state, "update", GroupStateTimeout.EventTimeTimeout)


def step_cells(stream: DataFrame, ts: str, grid: str, max_grid_id: int, step_minutes: int, watermark: str) -> DataFrame:
    """STM-2: per scheduled time, the rows and the distinct expected grid ids seen so far (``update`` mode).

    State is one bitmap of 4 KB per (time, 32,768 grid ids), whatever the number of rows; bitmaps are
    built per task before the shuffle.  A time is emitted again whenever it gets rows, with its whole
    count, so the latest version is the count so far, for open days as well as closed ones.  Rows
    off the schedule or outside ``0..max_grid_id`` are no cells (as in AGG-2, strict).  Times older
    than the watermark are closed: their state is dropped and later rows don't change them.
    """
    s = stream.filter(tx.on_schedule(ts, step_minutes) & F.col(grid).between(0, max_grid_id))
    s = event_time(s, ts).withWatermark("event_time", watermark)
    g = s.groupBy(F.window("event_time", f"{step_minutes} minutes").alias("w"), F.bitmap_bucket_number(grid).alias("bucket"))
    seen = g.agg(F.count(F.lit(1)).alias("rows"), F.bitmap_construct_agg(F.bitmap_bit_position(grid)).alias("bits"))
    return seen.select(wall_clock(F.col("w.start")).alias("ts"), "bucket", "rows", F.bitmap_count("bits").alias("cells"))


def day_report(spark: SparkSession, path: str, max_grid_id: int, step_minutes: int) -> DataFrame:
    """STM-2 merged: the completeness report (AGG-3) of every day seen so far, from the folder ``step_cells`` was run into."""
    return quality.report_of_counts(step_counts(spark, path), max_grid_id, step_minutes)


def step_counts(spark: SparkSession, path: str) -> DataFrame:
    """(date, time_point, arrived, rows, grids_present) of every time seen so far; a cell counts once in ``rows``."""
    cells = latest(spark, path, ["ts", "bucket"])
    return cells.groupBy(F.to_date("ts").alias("date"), tx.time_label("ts").alias("time_point")).agg(
        F.sum("rows").alias("arrived"), F.sum("cells").alias("rows"), F.sum("cells").alias("grids_present"))
