"""WIN-1 keep-first deduplication and SET-1 union of overlapping slices.

Keep-first is expressed as an aggregate, not as ``row_number`` over a window:
``min(struct(order..., payload...))`` is a declarative aggregate, so Spark runs a
partial (map-side) aggregate before the shuffle.  A hot (time, grid) key that
holds a large share of the rows is reduced to one row per map task before it
reaches a reducer, instead of being sorted in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ties broken by all remaining columns).

    The output has the input's columns in the input's order.  Order columns
    given by name travel once in the packed struct (as order fields).
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    order_names = [f"__o{i}" for i in range(len(order_cols))]
    by_name = {c: n for c, n in zip(order, order_names) if isinstance(c, str)}
    payload = [c for c in df.columns if c not in keys and c not in by_name]
    packed = F.struct(*[c.alias(n) for c, n in zip(order_cols, order_names)],
                      *[F.col(c) for c in payload])
    out = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return out.select(*[F.col(c) if c in keys else F.col(f"__first.{by_name.get(c, c)}").alias(c)
                        for c in df.columns])


def union_slices(slices: list[DataFrame]) -> DataFrame:
    """SET-1: concatenate slices by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)
