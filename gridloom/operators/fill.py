"""Gap filling in time (WIN-3, WIN-6, INT-1 linear) — native window functions.

A series is one grid cell over one day on the scaffold: the window partition is
(day, grid) and holds at most T rows whatever the data volume, so no partition
grows with the input.  The per-column gate (skip a column of a series with no
gap or with more than ``threshold`` missing) and the rain clip are evaluated in
the same window stage as the interpolation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridloom.functions.physics import clip


def series_window(series_keys: list[str], order: str) -> tuple[Window, Window, Window]:
    """(ascending window, rows up to the current one, rows from the current one on).

    The last frame runs over the descending order, so ``last`` there is the next value and
    both frames grow by one row per row: linear in the length of a series.  Times are unique in a series.
    """
    base = Window.partitionBy(*series_keys).orderBy(order)
    upto = base.rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*series_keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return base, upto, onward


def ffill_bfill(c: str, series_keys: list[str], order: str) -> Column:
    """WIN-3: carry the last known value forward, then the next one backward."""
    _, upto, onward = series_window(series_keys, order)
    return F.coalesce(F.last(c, ignorenulls=True).over(upto), F.last(c, ignorenulls=True).over(onward))


def linear_interpolate(c: str, series_keys: list[str], order: str, position: str) -> Column:
    """WIN-6: positional linear interpolation; trailing gaps take the last value, leading ones the next.

    Equal to pandas ``interpolate('linear').ffill().bfill()`` on the series.
    """
    _, upto, onward = series_window(series_keys, order)
    known_pos = F.when(F.col(c).isNotNull(), F.col(position))
    pv = F.last(c, ignorenulls=True).over(upto)
    pp = F.last(known_pos, ignorenulls=True).over(upto)
    nv = F.last(c, ignorenulls=True).over(onward)
    np_ = F.last(known_pos, ignorenulls=True).over(onward)
    inner = pv + (nv - pv) * ((F.col(position) - pp) / (np_ - pp))
    return (F.when(F.col(c).isNotNull(), F.col(c))
            .when(pv.isNotNull() & nv.isNotNull(), inner)
            .otherwise(F.coalesce(pv, nv)))


def temporal_fill_linear(df: DataFrame, columns: list[str], series_keys: list[str], order: str = "ts",
                         threshold: float = 0.2, clip_prefix: str = "rain") -> DataFrame:
    """INT-1 with the linear method for every column.

    Per series and column: no NULL → unchanged; NULL share above ``threshold`` →
    unchanged; otherwise gaps are filled by WIN-6 and, for columns whose name
    starts with ``clip_prefix``, the whole column of that series is clipped at 0.
    """
    base, _, _ = series_window(series_keys, order)
    whole = Window.partitionBy(*series_keys)
    out = df.withColumn("__pos", F.row_number().over(base).cast("double"))
    changes = {}
    for c in columns:
        share = F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).over(whole)
        gate = (share > 0) & (share <= threshold)
        filled = linear_interpolate(c, series_keys, order, "__pos")
        if c.lower().startswith(clip_prefix):
            filled = clip(filled, 0.0)
        changes[c] = F.when(gate, filled).otherwise(F.col(c))
    return out.withColumns(changes).drop("__pos")
