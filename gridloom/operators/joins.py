"""Size-checked dimension joins (JN-3, JN-4, JN-11) and key lookups (JN-9).

A broadcast hint is given only when Catalyst's size estimate for the small side
is under ``max_bytes``; otherwise the join is left to the planner, where AQE
still converts it to a broadcast at run time if the measured shuffle output is
small, and otherwise keeps a sort-merge join (with skew splitting enabled).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None when it cannot be read (e.g. Spark Connect)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate is advisory only
        return None


def dimension_join(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "left",
                   max_bytes: int = DEFAULT_MAX_BROADCAST) -> DataFrame:
    """Join a fact table with a small dimension; broadcast only below the size check."""
    size = estimated_bytes(dim)
    side = F.broadcast(dim) if size is not None and size <= max_bytes else dim
    return fact.join(side, on, how)


def key_lookup(df: DataFrame, lookups: DataFrame, key: str, target: str, order: str | None = None,
               out: str = "value") -> DataFrame:
    """JN-9: for each lookup key, the first ``target`` where ``key`` matches, else NULL.

    "First" is the smallest ``order`` (default: the target itself), taken with a
    partial aggregate so a key with many matches is reduced map-side.
    """
    ordering = F.col(order) if order else F.col(target)
    first = df.groupBy(key).agg(F.min_by(F.col(target), ordering).alias(out))
    return lookups.join(first, key, "left")
