"""Moments of packed vectors (NRM-1, AGG-9): count, mean and spread per position without exploding a row.

Each task folds the vectors it holds into one moment vector per group (count, mean and sum of
squared deviations per position, in float64), and only those are shuffled: tasks x groups x
positions entries, whatever the number of rows.  Moments merge exactly in any order by the
pairwise rule, so the second level is a plain aggregate.  Values may be nested one level
(``[node][feature]``): the moments are then per feature over all nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: groups a task keeps before it hands over what it has
HELD_GROUPS = 4096


def _folded(values: pa.Array, owner: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, n, mean, m2) of a list array whose rows belong to ``owner`` groups."""
    while pa.types.is_list(values.type.value_type) or pa.types.is_large_list(values.type.value_type):
        sizes = np.diff(values.offsets.to_numpy())
        owner = np.repeat(owner, sizes)
        values = values.flatten()
    sizes = np.diff(values.offsets.to_numpy())
    width = int(sizes.max()) if len(sizes) else 0
    if not width:
        return
    flat = values.flatten()
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    cell = np.repeat(owner, sizes) * width + at
    known = ~flat.is_null().to_numpy(zero_copy_only=False)
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)[known]
    cell = cell[known]
    n = np.bincount(cell, minlength=groups * width)
    mean = np.bincount(cell, x, minlength=groups * width) / np.maximum(n, 1)
    m2 = np.bincount(cell, (x - mean[cell]) ** 2, minlength=groups * width)
    for g in range(groups):
        part = slice(g * width, (g + 1) * width)
        yield g, n[part], mean[part], m2[part]


def _merge(a: tuple, b: tuple) -> tuple:
    """Moments of two disjoint sets of vectors; a shorter vector lacks the last positions."""
    width = max(len(a[0]), len(b[0]))
    (na, ma, sa), (nb, mb, sb) = (tuple(np.pad(v, (0, width - len(v))) for v in m) for m in (a, b))
    n = na + nb
    safe = np.maximum(n, 1)
    delta = mb - ma
    return n, ma + delta * nb / safe, sa + sb + delta * delta * na * nb / safe


def _partials(keys: list[str], vec: str, schema: pa.Schema):
    def rows(held: dict) -> pa.RecordBatch:
        task = TaskContext.get().partitionId()
        return pa.RecordBatch.from_pylist(
            [{**dict(zip(keys, k)), "task": task, "n": m[0].tolist(), "mean": m[1].tolist(), "m2": m[2].tolist()}
             for k, m in held.items()], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            present = batch.filter(batch.column(vec).is_valid())
            names = list(zip(*(present.column(k).to_pylist() for k in keys))) if keys else [()] * present.num_rows
            order = {k: i for i, k in enumerate(dict.fromkeys(names))}
            owner = np.fromiter((order[k] for k in names), np.int64, len(names))
            back = list(order)
            for g, *moment in _folded(present.column(vec), owner, len(back)):
                held[back[g]] = _merge(held[back[g]], tuple(moment)) if back[g] in held else tuple(moment)
            if len(held) > HELD_GROUPS:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)
    return run


def vector_moments(df: DataFrame, vec: str, by: list[str] | None = None) -> DataFrame:
    """(by, stats): per group one array of (pos, n, mean, std), population std over non-null values.

    A row whose vector is null counts nowhere; vectors may differ in length; a group without a
    value has no row.  Null keys form a group.
    """
    by = by or []
    keys = df.select(*by)
    partial_schema = T.StructType([*keys.schema.fields, T.StructField("task", T.LongType()), T.StructField("n", T.ArrayType(T.LongType())),
                                   T.StructField("mean", T.ArrayType(T.DoubleType())), T.StructField("m2", T.ArrayType(T.DoubleType()))])
    from pyspark.sql.pandas.types import to_arrow_schema

    partial = df.select(*by, vec).mapInArrow(_partials(by, vec, to_arrow_schema(partial_schema)), partial_schema)
    each = partial.select(*by, "task", F.posexplode(F.arrays_zip("n", "mean", "m2")).alias("pos", "m"))
    merged = each.groupBy(*by, "pos").agg(F.array_sort(F.collect_list(F.struct("task", "m.n", "m.mean", "m.m2"))).alias("parts"))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def join(a: Column, b: Column) -> Column:
        n, delta = a["n"] + b["n"], b["mean"] - a["mean"]
        safe = F.greatest(n, F.lit(1))
        return F.struct(n.alias("n"), (a["mean"] + delta * b["n"] / safe).alias("mean"),
                        (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / safe).alias("m2"))

    total = F.aggregate("parts", zero, join)
    rows = merged.select(*by, "pos", total.alias("t")).filter("t.n > 0")
    entry = F.struct("pos", F.col("t.n").alias("n"), F.col("t.mean").alias("mean"), F.sqrt(F.col("t.m2") / F.col("t.n")).alias("std"))
    grouped = rows.groupBy(*by) if by else rows
    return grouped.agg(F.array_sort(F.collect_list(entry)).alias("stats"))


def _scaled(vec: str, stats: Column, back: bool, nested: bool) -> Column:
    def one(x: Column, i: Column) -> Column:
        s = F.get(stats, i)
        std = F.when(s["std"] == 0, F.lit(1.0)).otherwise(s["std"])
        return x * std + s["mean"] if back else (x - s["mean"]) / std
    if nested:
        return F.transform(F.col(vec), lambda v: F.transform(v, one))
    return F.transform(F.col(vec), one)


def normalise(df: DataFrame, vec: str, stats: str, out: str, nested: bool = False) -> DataFrame:
    """NRM-1 apply: ``(x - mean) / std`` per position with the array column ``stats``; std 0 counts as 1."""
    return df.withColumn(out, _scaled(vec, F.col(stats), False, nested))


def denormalise(df: DataFrame, vec: str, stats: str, out: str, nested: bool = False) -> DataFrame:
    """NRM-1 inverse: ``z * std + mean``."""
    return df.withColumn(out, _scaled(vec, F.col(stats), True, nested))


def with_stats(df: DataFrame, vec: str, by: list[str] | None = None, fit: Column | None = None, out: str = "stats") -> DataFrame:
    """``df`` with the moments of its group beside every row, fitted on the rows that fulfil ``fit`` (all without).

    Without ``by`` the one array is a scalar subquery; with it the group table is joined (a group
    that the fitted rows lack has null statistics).
    """
    moments = vector_moments(df.filter(fit) if fit is not None else df, vec, by)
    if not by:
        return df.withColumn(out, moments.select("stats").scalar())
    right = moments.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("stats").alias(out))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    return df.join(right, same, "left").drop(*[f"__{c}" for c in by])


def train_boundary(df: DataFrame, day: str, share: float) -> Column:
    """First day after the training part: the earliest ``share`` of the days from the first to the last (a scalar)."""
    span = F.datediff(F.max(day), F.min(day)) + 1
    return df.agg(F.date_add(F.min(day), F.floor(span * share).cast("int"))).scalar()
