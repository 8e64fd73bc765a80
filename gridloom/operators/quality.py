"""Completeness, gap and validity reports (AGG-1/2/3/10/12/13, FLT-1/3/6/7, WIN-2, JN-6, VAL-1/2).

All per-day reports are hash aggregates keyed by day (or by day and time point),
so Spark combines map-side before the shuffle.  Lists that are collected per
day are bounded by the number of scheduled points of a day, never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridloom.functions import timeaxis as tx
from gridloom.operators.scaffold import date_range_days, id_range


def point_counts(obs: DataFrame, ts: str, grid: str, max_grid_id: int,
                 step_minutes: int, strict: bool = True) -> DataFrame:
    """AGG-2 input: per (date, time point) the rows and the distinct expected grid ids present.

    ``strict`` keeps only scheduled points and grid ids in ``0..max_grid_id`` (our
    default); ``strict=False`` counts every row as the reference does (quirk Q3).
    """
    df = obs.select(F.col(ts).alias("__ts"), F.col(grid).alias("__g"))
    if strict:
        df = df.filter(tx.on_schedule("__ts", step_minutes)
                       & F.col("__g").between(0, max_grid_id))
    in_range = F.when(F.col("__g").between(0, max_grid_id), F.col("__g"))
    return (df.groupBy(F.to_date("__ts").alias("date"), tx.time_label("__ts").alias("time_point"))
              .agg(F.count(F.lit(1)).alias("rows"),
                   F.count_distinct(in_range).alias("grids_present")))


def time_point_gaps(obs: DataFrame, ts: str, grid: str, max_grid_id: int,
                    step_minutes: int, strict: bool = True) -> DataFrame:
    """AGG-2: present time points with at least one expected grid id absent."""
    g = max_grid_id + 1
    return (point_counts(obs, ts, grid, max_grid_id, step_minutes, strict)
            .select("date", "time_point", (F.lit(g) - F.col("grids_present")).alias("missing_grids"))
            .filter(F.col("missing_grids") > 0))


def completeness(obs: DataFrame, ts: str = "ts", grid: str = "grid_id", max_grid_id: int = 4231,
                 step_minutes: int = 10, strict: bool = True) -> DataFrame:
    """AGG-3: one row per day that has data.

    Columns: date, total_time_points, complete_time_points, incomplete_time_points_count,
    missing_time_points_count, expected_points, actual_points, completeness_ratio,
    missing_time_points (array<string>, sorted), incomplete_time_points (map<string,int>).
    """
    return report_of_counts(point_counts(obs, ts, grid, max_grid_id, step_minutes, strict), max_grid_id, step_minutes)


def report_of_counts(pc: DataFrame, max_grid_id: int, step_minutes: int) -> DataFrame:
    """AGG-3 from (date, time_point, rows, grids_present), however these were counted."""
    g = max_grid_id + 1
    t = 1440 // step_minutes
    gap = F.lit(g) - F.col("grids_present")
    per_day = pc.groupBy("date").agg(
        F.sum("rows").alias("actual_points"),
        F.collect_set("time_point").alias("__present"),
        F.count_if(gap > 0).alias("incomplete_time_points_count"),
        F.map_from_entries(F.sort_array(F.collect_list(
            F.when(gap > 0, F.struct(F.col("time_point"), gap.cast("int")))))).alias("incomplete_time_points"),
    )
    present_on_schedule = F.size(F.array_intersect("__present", tx.day_labels(step_minutes)))
    missing_n = F.lit(t) - present_on_schedule
    return per_day.select(
        "date",
        F.lit(t).cast("bigint").alias("total_time_points"),
        (F.lit(t) - missing_n - F.col("incomplete_time_points_count")).cast("bigint").alias("complete_time_points"),
        F.col("incomplete_time_points_count").cast("bigint").alias("incomplete_time_points_count"),
        missing_n.cast("bigint").alias("missing_time_points_count"),
        F.lit(t * g).cast("bigint").alias("expected_points"),
        F.col("actual_points").cast("bigint").alias("actual_points"),
        (F.col("actual_points") / F.lit(t * g)).alias("completeness_ratio"),
        F.array_sort(F.array_except(tx.day_labels(step_minutes), F.col("__present"))).alias("missing_time_points"),
        "incomplete_time_points",
    )


def completeness_filter(obs: DataFrame, report: DataFrame, ts: str = "ts",
                        threshold: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """FLT-3: rows of days whose ratio >= threshold, and the ignored days.

    A day absent from the report has a NULL ratio and is ignored (quirk Q6).
    The report has one row per day; Spark's runtime size check decides whether it is broadcast.
    """
    keep_days = report.filter(F.col("completeness_ratio") >= threshold).select("date")
    kept = obs.join(keep_days, F.to_date(obs[ts]) == keep_days["date"], "left_semi")
    all_days = obs.select(F.to_date(ts).alias("date")).distinct()
    ignored = (all_days.join(report.select("date", "completeness_ratio"), "date", "left")
               .filter(F.col("completeness_ratio").isNull()
                       | (F.col("completeness_ratio") < threshold)))
    return kept, ignored


def missing_times(obs: DataFrame, ts: str, step_minutes: int, by: list[str] | None = None) -> DataFrame:
    """JN-6: scheduled timestamps of every day with data that have no row at all.

    With ``by`` (e.g. a grid id) the check runs per series: a day counts as "with
    data" for a series when the series has a row that day.
    """
    by = by or []
    present = obs.select(*by, F.col(ts).alias("ts")).distinct()
    days = present.select(*by, F.to_date("ts").alias("date")).distinct()
    expected = days.select(*by, "date", F.explode(tx.day_points("date", step_minutes)).alias("ts"))
    return expected.join(present, [*by, "ts"], "left_anti")


def gap_runs(missing: DataFrame, step_minutes: int, ts: str = "ts", by: list[str] | None = None) -> DataFrame:
    """WIN-2 generalised: islands of consecutive missing times per day.

    One row per run with its start, end and length; ``adjacent`` is true when the
    run holds at least two points exactly one step apart (the reference's warning).
    The window is partitioned by day and spans only the day's missing points.
    """
    by = by or []
    w = Window.partitionBy(*by, "date").orderBy(ts)
    step_s = step_minutes * 60
    secs = tx.epoch_seconds(ts)
    brk = F.when(secs - F.lag(secs).over(w) == step_s, 0).otherwise(1)
    marked = (missing.withColumn("date", F.to_date(ts)).withColumn("__brk", brk)
              .withColumn("run", F.sum("__brk").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (marked.groupBy(*by, "date", "run")
            .agg(F.min(ts).alias("run_start"), F.max(ts).alias("run_end"),
                 F.count(F.lit(1)).alias("run_length"))
            .withColumn("adjacent", F.col("run_length") > 1))


def step_index(df: DataFrame, ts: str) -> DataFrame:
    """WIN-5 + AGG-7: per distinct time its 0-based step within the day and the day's time count.

    The window spans the distinct times of one day only (≤ one per second), so a
    day that holds many rows is still numbered in a bounded partition.
    """
    times = df.select(F.col(ts).alias("ts")).distinct().withColumn("date", F.to_date("ts"))
    w = Window.partitionBy("date").orderBy("ts")
    return times.select("ts", (F.dense_rank().over(w) - 1).cast("bigint").alias("step"),
                        F.count(F.lit(1)).over(Window.partitionBy("date")).alias("n_times")) \
                .withColumnRenamed("ts", ts)


def sentinel_to_null(df: DataFrame, columns: list[str], sentinel: float = 0.0) -> DataFrame:
    """FLT-7: a sentinel value (0 pressure, 0 humidity) becomes NULL."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns})


def sentinel_counts(df: DataFrame, ts: str, columns: list[str], sentinel: float = 0.0) -> DataFrame:
    """AGG-12: per day, how many values of each column equal the sentinel."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        *[F.count_if(F.col(c) == sentinel).alias(f"{c}_abnormal") for c in columns])


def null_fraction(c: str | Column) -> Column:
    """AGG-10 building block: share of NULLs (use with ``over`` or inside ``agg``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.avg(F.when(col.isNull(), 1.0).otherwise(0.0))


def null_report(df: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """FLT-6 + AGG-10: per day, whether any value is NULL and each column's NULL share."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        F.bool_or(F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1
                  else F.col(columns[0]).isNull()).alias("any_null"),
        *[null_fraction(c).alias(f"{c}_null_share") for c in columns])


def date_range(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """AGG-1: overall min start / max end."""
    return df.agg(F.min(start).alias("min_time"), F.max(end or start).alias("max_time"))


def day_filter(df: DataFrame, ts: str, day: str | Column) -> DataFrame:
    """FLT-1: rows with ``day <= ts < day + 1`` (same result as ``<= 23:59:59`` at second resolution)."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    start = d.cast("timestamp_ntz")
    return df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY")))


def day_status(df: DataFrame, ts: str, steps_per_day: int, grids: int) -> DataFrame:
    """AGG-13 / VAL-1 / VAL-2: per day rows and distinct times versus T×G and T, with a reason."""
    per_day = df.groupBy(F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(ts).alias("steps"))
    exp_rows = steps_per_day * grids
    reason = (F.when(F.col("rows") != exp_rows,
                     F.format_string(f"expected {exp_rows} rows, got %d", F.col("rows")))
              .when(F.col("steps") != steps_per_day,
                    F.format_string(f"expected {steps_per_day} time steps, got %d", F.col("steps"))))
    return per_day.select(
        "date", F.col("rows").cast("bigint").alias("rows"), F.col("steps").cast("bigint").alias("steps"),
        F.when(reason.isNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        reason.alias("reason"))


def missing_numbers(have: DataFrame, number: str, first: int = 1) -> DataFrame:
    """JN-8: numbers ``first`` .. the largest present that are absent; null numbers count nowhere."""
    known = have.select(F.col(number).cast("bigint").alias(number)).filter(F.col(number).isNotNull()).distinct()
    bounds = known.agg(F.lit(first).alias("lo"), F.max(number).alias("hi"))
    return id_range(bounds, "lo", "hi").withColumnRenamed("value", number).join(known, number, "left_anti")


def missing_dates(have: DataFrame, date: str = "date") -> DataFrame:
    """JN-7: calendar dates between the first and the last present that are absent."""
    known = have.select(F.to_date(date).alias(date)).filter(F.col(date).isNotNull()).distinct()
    bounds = known.agg(F.min(date).alias("s"), F.max(date).alias("e"))
    return date_range_days(bounds, "s", "e").withColumnRenamed("date", date).join(known, date, "left_anti")


def chunk_groups(missing: DataFrame, first: Column, last: Column, days: int, date: str = "date") -> DataFrame:
    """AGG-11 + DT-4: missing dates by chunk of ``days`` days from ``first`` and by month: the days as text and their number."""
    c = missing.withColumn("chunk", tx.chunk_index(date, first, days))
    start = F.date_add(first, (F.col("chunk") * days).cast("int"))
    plan = c.groupBy("chunk", F.year(date).alias("year"), F.month(date).alias("month")).agg(
        F.array_join(F.array_sort(F.collect_list(F.date_format(date, "dd"))), ",").alias("days"), F.count(F.lit(1)).alias("n_days"))
    return plan.select("chunk", start.alias("chunk_start"), F.least(F.date_add(start, days - 1), last, F.current_date()).alias("chunk_end"),
                       "year", "month", "days", "n_days")
