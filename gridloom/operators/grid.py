"""Grid ids, global positions, reanalysis merging and truncation (WIN-4, AGG-5/6, JN-4, FLT-5, VAL-1).

No operator here uses a window without a partition: global positions are
computed from per-bucket counts (one row per bucket), a two-level prefix scan of
the bucket table, and a ``row_number`` inside each bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridloom.operators.scan import prefix_sums


def global_position(df: DataFrame, bucket: Column, order: list[str | Column], out: str = "pos") -> DataFrame:
    """0-based position of each row in ``(bucket, *order)`` order.

    ``bucket`` must be monotone in the order (e.g. the first order key, or
    ``floor(key / width)``).  The bucket table — one row per bucket — gets its running
    totals from a parallel scan; rows are numbered inside their own bucket.  A row with a
    null bucket has no position and is left out.
    """
    b = df.withColumn("__b", bucket)
    counts = b.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = prefix_sums(counts, ["__b"], "__n", "__off").select("__b", "__off")
    ranked = b.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy(*order)) - 1)
    return ranked.join(offsets, "__b").withColumn(out, (F.col("__off") + F.col("__r")).cast("bigint")) \
                 .drop("__b", "__off", "__r")


def distinct_coords(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """AGG-6: distinct (lon, lat) pairs."""
    return df.select(lon, lat).distinct()


def grid_ids(df: DataFrame, lon: str = "lon", lat: str = "lat", out: str = "grid_id") -> DataFrame:
    """WIN-4: id = rank of (lat, lon) over the distinct coordinates, from 0.

    Buckets are the distinct latitudes, so each ``row_number`` spans one row of the grid.
    """
    coords = distinct_coords(df, lon, lat)
    return global_position(coords, F.col(lat), [lon], out)


def attach_grid_ids(df: DataFrame, lon: str = "lon", lat: str = "lat", out: str = "grid_id") -> DataFrame:
    """JN-4: derived ids back onto the rows by (lon, lat).

    Keys are exact: both sides hold the same doubles.  The id table has one row
    per grid point; Spark's runtime size check decides whether it is broadcast.
    """
    return df.join(grid_ids(df, lon, lat, out), [lon, lat], "left")


def first_non_null(df: DataFrame, keys: list[str], order: str | Column, columns: list[str] | None = None) -> DataFrame:
    """AGG-5: one row per key; per column the first non-NULL value in ``order``.

    ``min_by(c, when(c is not null, order))`` ignores rows whose ordering is NULL,
    i.e. rows where the column is NULL; it is a partial aggregate.
    """
    ordc = F.col(order) if isinstance(order, str) else order
    cols = columns or [c for c in df.columns if c not in keys and (not isinstance(order, str) or c != order)]
    return df.groupBy(*keys).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordc)).alias(c) for c in cols])


def merge_cubes(cubes: list[DataFrame], keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """SRC-8: cubes aligned by their coordinates; one row per key, each variable from the first cube that has it.

    Variables are those of all cubes; a cube may lack some.  Column ``conflicts`` names, in order, the variables
    for which two cubes hold values at the key that differ by more than ``tolerance``: they are merged by the
    order of the cubes, and reported, never settled in silence.  Keys compare exactly, as the cubes of one
    source do; round them before for cubes that don't.  A cube that has a key twice counts as its first
    non-null value (AGG-5 in the order of the value itself), and its own disagreement is a conflict too.
    """
    variables = list(dict.fromkeys(c for cube in cubes for c in cube.columns if c not in keys))
    numbered = [cube.withColumn("__cube", F.lit(n)) for n, cube in enumerate(cubes)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    held = {v: F.col(v).isNotNull() for v in variables}
    merged = both.groupBy(*keys).agg(
        *[F.min_by(F.col(v), F.when(held[v], F.struct("__cube", v))).alias(v) for v in variables],
        *[(F.max(v) - F.min(v) > tolerance).alias(f"__differs_{v}") for v in variables])
    names = [F.when(F.col(f"__differs_{v}"), F.lit(v)) for v in variables]
    return merged.select(*keys, *variables, F.array_compact(F.array(*names)).alias("conflicts"))


def tail_truncate(df: DataFrame, ts: str, keys: list[str], steps: int, grids: int) -> DataFrame:
    """FLT-5: keep the last ``steps * grids`` rows of each day in (ts, *keys) order.

    Rows are counted per (day, ts) with a partial aggregate; a window over the
    distinct times of a day gives the rows that come later; only the boundary
    time is numbered row by row (partitioned by (day, ts), i.e. one time step).
    Days with fewer rows keep all of them (``day_status`` reports them).
    """
    limit = steps * grids
    d = df.withColumn("__day", F.to_date(ts))
    per_ts = d.groupBy("__day", ts).agg(F.count(F.lit(1)).alias("__n"))
    later = per_ts.withColumn("__later", F.coalesce(F.sum("__n").over(
        Window.partitionBy("__day").orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    later = later.filter(F.col("__later") < limit).drop("__n")
    kept = d.join(later, ["__day", ts])
    w = Window.partitionBy("__day", ts).orderBy(*[F.col(k).desc() for k in keys])
    kept = kept.withColumn("__r", F.row_number().over(w))
    return kept.filter(F.col("__later") + F.col("__r") <= limit).drop("__day", "__later", "__r")
