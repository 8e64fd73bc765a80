"""Interval overlap of file time spans with calendar days (JN-5, FLT-2).

``span_days`` is the direct form: every span expands into the days it touches,
which turns the theta join into an equi-join on the day.  Its output is the sum
of span lengths, fine for page files (minutes to hours each) but not for long
spans.  ``day_overlap`` answers the per-day questions — how many spans touch the
day, and which is the first in (start, key) order — with sweeps whose size is
the number of spans plus the number of covered days:

* counts: +1 at a span's first day, -1 the day after its last day, running sum
  over the distinct boundary days;
* first span: in (start, key) order, only spans whose last day exceeds the last
  day of every earlier span ("records") can be first for any day, and record r
  is first exactly on ``[max(start_r, previous record end + 1), end_r]`` — these
  ranges are disjoint, so expanding them yields at most one row per day.

The running maximum behind the records is computed per start day (a bounded
partition) plus a prefix maximum over the distinct start days, so no window
spans all spans.  The only unpartitioned windows run over distinct days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def span_days(spans: DataFrame, start: str, end: str, out: str = "date") -> DataFrame:
    """JN-5 direct form: one row per (span, day it overlaps)."""
    return spans.withColumn(out, F.explode(F.sequence(F.to_date(start), F.to_date(end))))


def overlap_counts(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Per covered day, the number of spans that overlap it (sweep over boundary days)."""
    s = spans.select(F.to_date(start).alias("s"), F.to_date(end).alias("e"))
    deltas = s.select(F.col("s").alias("d"), F.lit(1).alias("k")).unionByName(
        s.select(F.date_add("e", 1).alias("d"), F.lit(-1).alias("k")))
    per_day = deltas.groupBy("d").agg(F.sum("k").alias("k"))
    w = Window.orderBy("d")
    run = per_day.select("d", F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
                         F.lead("d").over(w).alias("next_d"))
    covered = run.filter((F.col("n") > 0) & F.col("next_d").isNotNull())
    return covered.select(F.explode(F.sequence("d", F.date_sub("next_d", 1))).alias("date"),
                          F.col("n").cast("bigint").alias("n_spans"))


def first_covering(spans: DataFrame, start: str, end: str, key: str, payload: list[str]) -> DataFrame:
    """Per covered day, ``payload`` of the first span in (start, key) order that overlaps it."""
    s = spans.select(F.col(start).alias("__start"), F.col(key).alias("__key"), *payload,
                     F.to_date(start).alias("__sd"), F.to_date(end).alias("__ed"))
    within = Window.partitionBy("__sd").orderBy("__start", "__key").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("__prev_in_day", F.max("__ed").over(within))
    day_max = s.groupBy("__sd").agg(F.max("__ed").alias("__dmax"))
    before = day_max.select("__sd", F.max("__dmax").over(
        Window.orderBy("__sd").rowsBetween(Window.unboundedPreceding, -1)).alias("__prev_days"))
    s = s.join(before, "__sd")
    prev = F.greatest(F.col("__prev_in_day"), F.col("__prev_days"))  # greatest skips NULLs
    records = s.filter(prev.isNull() | (F.col("__ed") > prev))
    first_day = F.when(prev.isNull(), F.col("__sd")).otherwise(F.greatest(F.col("__sd"), F.date_add(prev, 1)))
    return records.select(*payload, F.explode(F.sequence(first_day, F.col("__ed"))).alias("date"))


def day_overlap(spans: DataFrame, start: str, end: str, key: str, payload: list[str]) -> DataFrame:
    """FLT-2 + JN-5 per day: number of overlapping spans and the first span's payload."""
    return overlap_counts(spans, start, end).join(first_covering(spans, start, end, key, payload), "date", "left")
