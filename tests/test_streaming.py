"""Incremental ingest: files arriving in several triggers, conflicting and late rows, open days, restarts."""

import datetime as dt
import random

import pyspark.sql.functions as F

from gridloom.operators import dedup, quality
from gridloom.session import scratch_path
from gridloom.streaming import ingest, upserts

SCHEMA = "ts timestamp_ntz, grid_id bigint, page bigint, v double"


def _t(h, d=1):
    return dt.datetime(2024, 1, d, h)


class Arrivals:
    """A folder that gets files, and one query over it that resumes from its checkpoint."""

    def __init__(self, spark, plan, keys, partition_by=None):
        self.spark, self.plan, self.keys, self.partition_by = spark, plan, keys, partition_by
        self.src, self.out, self.ck = (scratch_path(spark, n) for n in ("t-src", "t-out", "t-ck"))

    def take(self, *files):
        for rows in files:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.src)
        schema = self.spark.createDataFrame([], SCHEMA).schema
        stream = ingest.file_stream(self.spark, self.src, schema, max_files_per_trigger=1)
        upserts.run_updates(self.plan(stream), self.out, self.ck, self.partition_by)
        return self

    def latest(self, only="true"):
        return upserts.latest(self.spark, self.out, self.keys, only)


def _leaders(spark, watermark):
    return Arrivals(spark, lambda s: ingest.keep_first_stream(s, "ts", ["grid_id"], ["page"], watermark),
                    ["ts", "grid_id"], ["late"])


def test_leaders_equal_batch_keep_first(spark):
    rnd = random.Random(6)
    rows = [(_t(rnd.randrange(24), rnd.randint(1, 3)), rnd.randrange(3), page, float(page)) for page in range(300)]
    rnd.shuffle(rows)
    a = _leaders(spark, "30 days").take(rows[:100]).take(rows[100:180], rows[180:])
    got = {(r.ts, r.grid_id): (r.page, r.v) for r in a.latest("late = 0").collect()}
    batch = dedup.dedup_keep_first(spark.createDataFrame(rows, SCHEMA), ["ts", "grid_id"], ["page"])
    assert got == {(r.ts, r.grid_id): (r.page, r.v) for r in batch.collect()}
    assert spark.read.parquet(a.out).filter("late = 1").count() == 0


def test_late_rows_are_kept_apart(spark):
    a = _leaders(spark, "30 minutes")
    a.take([(_t(10), 0, 5, 1.0), (_t(10), 0, 4, 2.0), (_t(11), 1, 6, 3.0), (_t(12), 0, 7, 4.0), (None, 0, 0, 9.0)])
    a.take([(_t(10), 0, 1, 9.0),        # before 11:30: late, although its page would lead
            (_t(12), 0, 2, 8.0),        # not late, takes the lead
            (_t(12), 0, 9, 7.0),        # not late, does not
            (_t(13), 1, 8, 5.0)])
    lead = {(r.ts, r.grid_id): (r.page, r.v) for r in a.latest("late = 0").collect()}
    assert lead == {(_t(10), 0): (4, 2.0), (_t(11), 1): (6, 3.0), (_t(12), 0): (2, 8.0), (_t(13), 1): (8, 5.0)}
    late = spark.read.parquet(a.out).filter("late = 1").collect()
    assert [(r.ts, r.page) for r in late] == [(_t(10), 1)]
    a.take([(_t(12, 2), 0, 10, 1.0)]).take([(_t(12), 0, 0, 0.0)])  # the first day is closed: nothing changes there
    assert {(r.ts, r.grid_id): (r.page, r.v) for r in a.latest("late = 0").collect()} == lead | {(_t(12, 2), 0): (10, 1.0)}
    assert spark.read.parquet(a.out).filter("late = 1").count() == 2


def test_cells_of_open_days(spark):
    rows = [(_t(h, d), g, 0, 1.0) for d in (1, 2, 3) for h in (0, 6, 23) for g in range(3)]
    odd = [(_t(6, 3), 7, 0, 1.0), (dt.datetime(2024, 1, 3, 6, 30), 0, 0, 1.0), (None, 1, 0, 1.0), (_t(6, 3), None, 0, 1.0)]
    a = Arrivals(spark, lambda s: ingest.step_cells(s, "ts", "grid_id", 3, 60, "30 days"), ["ts", "bucket"])
    a.take(rows[:10] + odd, rows[5:20]).take(rows[15:])
    counts = {(r.date.day, r.time_point): (r.arrived, r.rows) for r in ingest.step_counts(spark, a.out).collect()}
    assert {k: v[1] for k, v in counts.items()} == {(d, h): 3 for d in (1, 2, 3) for h in ("00:00", "06:00", "23:00")}
    assert sum(v[0] for v in counts.values()) == 10 + 15 + 12
    want = quality.completeness(spark.createDataFrame(rows, SCHEMA), "ts", "grid_id", 3, 60)
    show = ["date", "complete_time_points", "missing_time_points_count", "actual_points", "completeness_ratio", "missing_time_points"]
    assert sorted(ingest.day_report(spark, a.out, 3, 60).select(*show).collect()) == sorted(want.select(*show).collect())


def test_compact_keeps_the_latest(spark):
    a = _leaders(spark, "30 days")
    a.take([(_t(1), 0, 5, 1.0), (_t(2), 0, 5, 1.0)]).take([(_t(1), 0, 3, 2.0)])
    into = scratch_path(spark, "t-compact")
    upserts.compact(spark, a.out, ["ts", "grid_id"], into)
    assert spark.read.parquet(into).count() == 2
    assert sorted(upserts.latest(spark, into, ["ts", "grid_id"]).select("ts", "page").collect()) == [(_t(1), 3), (_t(2), 5)]
    again = spark.read.parquet(a.out).select(F.max("batch")).first()[0]
    assert spark.read.parquet(into).select("batch").distinct().collect() == [(again,)]
