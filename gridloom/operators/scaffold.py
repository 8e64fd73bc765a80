"""The (time × grid) scaffold and the joins that put observations on it (JN-1/2/3, PRJ-4).

The scaffold is generated, not cross-joined: every day row expands into its
scheduled timestamps and then into the grid ids ``0..max_grid_id`` with
``explode(sequence(...))``.  The output per day is T×G rows by definition, and the
work is spread over days (or, after the join, over the (ts, grid) hash partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import timeaxis as tx
from gridloom.operators.joins import dimension_join


def scaffold(days: DataFrame, step_minutes: int, max_grid_id: int, day: str = "date") -> DataFrame:
    """JN-1: one row per (date, ts, grid_id) for every scheduled point and grid id of each day."""
    times = days.select(F.col(day).alias("date"),
                        F.explode(tx.day_points(day, step_minutes)).alias("ts"))
    return times.select("date", "ts",
                        F.explode(F.sequence(F.lit(0).cast("bigint"),
                                             F.lit(max_grid_id).cast("bigint"))).alias("grid_id"))


def data_days(obs: DataFrame, ts: str = "ts") -> DataFrame:
    return obs.select(F.to_date(ts).alias("date")).distinct()


def center_coords(df: DataFrame) -> DataFrame:
    """PRJ-4: cell centre = (min + max) / 2 in lon and lat."""
    return df.withColumns({
        "lon_center": (F.col("lon_min") + F.col("lon_max")) / 2.0,
        "lat_center": (F.col("lat_min") + F.col("lat_max")) / 2.0,
    })


def align(obs: DataFrame, grid: DataFrame | None, step_minutes: int, max_grid_id: int,
          ts: str = "ts", grid_col: str = "grid_id") -> DataFrame:
    """JN-1 + JN-2 + JN-3: observations (unique per (ts, grid)) on the full scaffold of their days.

    The days are those of *all* observations.  Missing cells are NULL in every measure and get
    ``observed = false``; observations off the step schedule or outside the grid-id range find no
    cell and are left out, as in a left join of the scaffold with the observations (a day that has
    only such rows is a day of NULL cells).

    The T×G cells are never shuffled: observations are collected per (day, grid), at most T of
    them, in one pass over the input that also gives the days; the small (day × grid) table is left-joined with those lists, and each row expands in
    place into its observed steps plus the missing ones (``array_except`` against ``0..T-1``).
    The output is partitioned by (day, grid), so per-series windows run without another exchange.
    Grid bounds are joined by id (the grid table, filtered to the id range, has at most
    ``max_grid_id + 1`` rows; the broadcast is size-checked) and centres derived.
    """
    steps = 1440 // step_minutes
    o = obs.withColumnRenamed(ts, "ts").withColumnRenamed(grid_col, "grid_id")
    values = [f for f in o.schema.fields if f.name not in ("ts", "grid_id")]
    o = o.filter(F.col("ts").isNotNull() & F.to_date("ts").isNotNull())
    out = _expand_series(o, values, steps, step_minutes, max_grid_id)
    if grid is not None:
        g = grid.filter(F.col("grid_id").between(0, max_grid_id))
        out = center_coords(dimension_join(out, g, "grid_id", "left"))
    return out


def _expand_series(o: DataFrame, values: list, steps: int, step_minutes: int, max_grid_id: int) -> DataFrame:
    # one aggregate of all rows serves both sides of the join: rows off the scaffold stay out of the lists but name their day
    fits = tx.on_schedule("ts", step_minutes) & F.col("grid_id").between(0, max_grid_id)
    entry = F.struct(tx.step_of_day("ts", step_minutes).alias("k"), *[F.col(f.name) for f in values], F.lit(True).alias("observed"))
    # keys without nulls leave the join nothing to filter, and reading the list on the day side keeps its column:
    # both sides are the same aggregate, so its exchange is made once and reused
    keys = [F.to_date("ts").alias("date"), F.coalesce("grid_id", F.lit(-1).cast("bigint")).alias("grid_id")]
    cells = o.groupBy(*keys).agg(F.collect_list(F.when(fits, entry)).alias("__obs"))
    days = cells.filter(F.size("__obs") >= 0).select("date").distinct()
    obs_type = cells.schema["__obs"].dataType.simpleString()
    series = days.select("date", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                      F.lit(max_grid_id).cast("bigint"))).alias("grid_id"))
    j = series.join(cells, ["date", "grid_id"], "left")
    have = F.coalesce(F.col("__obs"), F.array().cast(obs_type))
    # observed steps as collected, the other steps as NULL cells: O(T) per series, no lookups
    gaps = F.transform(F.array_except(F.sequence(F.lit(0), F.lit(steps - 1)), have["k"]),
                       lambda k: F.struct(k.alias("k"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in values],
                                          F.lit(False).alias("observed")))
    e = j.select("date", "grid_id", F.inline(F.concat(have, gaps)))
    return e.select((F.col("date").cast("timestamp_ntz") + tx.minutes(F.col("k") * step_minutes)).alias("ts"),
                    "grid_id", "date", *[f.name for f in values], "observed")


def id_range(bounds: DataFrame, lo: str, hi: str, chunk: int = 4096) -> DataFrame:
    """All integers ``lo..hi`` (inclusive) of each bounds row, generated in chunks.

    The bounds table is tiny; it expands first into chunk numbers, which are
    hash-partitioned before each chunk expands into its values, so a long range is
    generated by many tasks instead of one.
    """
    chunks = bounds.select(F.col(lo).cast("bigint").alias("__lo"), F.col(hi).cast("bigint").alias("__hi")) \
        .filter(F.col("__lo") <= F.col("__hi")) \
        .select("__lo", "__hi", F.explode(F.sequence(F.floor(F.col("__lo") / chunk).cast("bigint"),
                                                      F.floor(F.col("__hi") / chunk).cast("bigint"))).alias("__c"))
    chunks = chunks.repartition("__c")
    start = F.greatest(F.col("__lo"), F.col("__c") * chunk)
    end = F.least(F.col("__hi"), F.col("__c") * chunk + (chunk - 1))
    return chunks.select(F.explode(F.sequence(start, end)).alias("value"))


def date_range_days(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """DT-3 at scale: every date from ``start`` to ``end`` (inclusive), generated in chunks."""
    b = bounds.select(F.unix_date(F.to_date(start)).alias("__s"), F.unix_date(F.to_date(end)).alias("__e"))
    return id_range(b, "__s", "__e").select(F.date_from_unix_date(F.col("value").cast("int")).alias("date"))
