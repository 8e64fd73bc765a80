"""Mean field, projections and scalar group scores (AGG-4, FLT-4, SET-2, PRJ-1..7, AGG-9); vectors are in ``moments``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.dedup import union_slices


def with_mean_field(df: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """AGG-4 + SET-2: prepend per-timestamp means (NULLs skipped) as rows without a grid id.

    The mean rows carry ``is_mean_field = true``; grid rows ``false``.  The means
    are a partial hash aggregate by timestamp.
    """
    means = df.groupBy(ts).agg(*[F.avg(c).alias(c) for c in columns]).withColumn("is_mean_field", F.lit(True))
    both = union_slices([means, df.withColumn("is_mean_field", F.lit(False))])
    return both.select(*df.columns, "is_mean_field")


def drop_mean_field(df: DataFrame) -> DataFrame:
    """FLT-4: the grid rows only (a flag instead of the first-144-rows position)."""
    return df.filter(~F.col("is_mean_field")).drop("is_mean_field")


def keep_columns(df: DataFrame, keep: list[str], strict: bool = True) -> DataFrame:
    """PRJ-1: keep-list; ``strict`` raises on an absent column, otherwise keeps the intersection."""
    missing = [c for c in keep if c not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[c for c in keep if c in df.columns])


# Bookkeeping dimensions dropped from raw reanalysis tables (PRJ-2).
BOOKKEEPING = ("number", "step", "surface", "heightAboveGround", "entireAtmosphere", "expver")
# Accepted spellings of the time and coordinate columns (PRJ-3).
TIME_NAMES = ("valid_time", "time")
LON_NAMES = ("longitude",)
LAT_NAMES = ("latitude",)


def drop_columns(df: DataFrame, names: tuple[str, ...] | list[str] = BOOKKEEPING) -> DataFrame:
    """PRJ-2: drop bookkeeping dimensions, keep everything else in order."""
    return df.drop(*[c for c in names if c in df.columns])


def unify_names(df: DataFrame, time_out: str = "ts", lon_out: str = "lon", lat_out: str = "lat") -> DataFrame:
    """PRJ-3: one spelling for time and coordinates; error when there is no time column."""
    ren = {}
    t = next((n for n in TIME_NAMES if n in df.columns), None)
    if t is None and time_out not in df.columns:
        raise ValueError("no time column")
    if t is not None:
        ren[t] = time_out
    for names, out in ((LON_NAMES, lon_out), (LAT_NAMES, lat_out)):
        for n in names:
            if n in df.columns:
                ren[n] = out
    return df.withColumnsRenamed(ren) if ren else df


def add_missing_zero(df: DataFrame, features: list[str]) -> DataFrame:
    """PRJ-5: a configured feature that is absent becomes 0.0."""
    absent = {c: F.lit(0.0) for c in features if c not in df.columns}
    return df.withColumns(absent) if absent else df


def order_columns(df: DataFrame, order: list[str]) -> DataFrame:
    """PRJ-6: fixed output order."""
    return df.select(*order)


def group_zscore(df: DataFrame, group: list[str], columns: list[str], suffix: str = "_z") -> DataFrame:
    """AGG-9: z-score within a group (population std; std 0 → divide by 1).

    Group statistics are a partial aggregate joined back on the group key, so a
    hot group is combined map-side and the join can be split by AQE.
    """
    stats = df.groupBy(*group).agg(*[F.avg(c).alias(f"__m_{c}") for c in columns],
                                   *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns])
    j = df.join(stats, group, "left")
    out = {}
    for c in columns:
        s = F.col(f"__s_{c}")
        out[c + suffix] = (F.col(c) - F.col(f"__m_{c}")) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return j.withColumns(out).drop(*[f"__m_{c}" for c in columns], *[f"__s_{c}" for c in columns])
