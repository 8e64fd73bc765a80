"""Dense tensors, training samples and windows (TNS-1/2, SMP-1..6, VAL-4).

The long form — one row per (group, step, node, channel) — is canonical.
Windows are built by replicating each step row into the (at most L) windows
that contain it and grouping by window, so no operator sorts a whole series in
one task and no window function runs without a partition.  Packing into arrays
happens per (day, step) or per window, which bounds every collected list by the
tensor shape (G×F or L×G×F), never by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import geo


def check_window(steps_per_group: int, window: int, tumbling: bool = False) -> None:
    """VAL-4: a window must fit in a group; a tumbling window must divide it."""
    if window <= 0:
        raise ValueError("window length must be positive")
    if window > steps_per_group:
        raise ValueError(f"window length {window} exceeds {steps_per_group} steps")
    if tumbling and steps_per_group % window:
        raise ValueError(f"{steps_per_group} steps are not a multiple of the window length {window}")


def wide_to_long(df: DataFrame, ids: list[str], value_cols: list[str], index_name: str,
                 value_name: str = "value") -> DataFrame:
    """TNS-1 / SRC-9: wide table → long, the column position becoming ``index_name`` (node or channel)."""
    pos = F.create_map(*[x for i, c in enumerate(value_cols) for x in (F.lit(c), F.lit(i))])
    long = df.unpivot(ids, value_cols, "__name", value_name)
    return long.select(*ids, pos[F.col("__name")].cast("bigint").alias(index_name), value_name)


def pack_steps(df: DataFrame, keys: list[str], node: str, features: list[str], out: str = "features") -> DataFrame:
    """TNS-2: rows (keys…, node, features…) → one row per keys with ``array<array<float>>`` in node order.

    Each collected list holds one entry per node of the group (G of them).
    """
    entry = F.struct(F.col(node).alias("n"), F.array(*[F.col(f).cast("float") for f in features]).alias("v"))
    return df.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"]).alias(out),
        F.array_sort(F.collect_list(F.col(node))).alias("nodes"))


def unpack_steps(df: DataFrame, keys: list[str], col: str = "features", node: str = "node_pos",
                 feature: str = "feature", value: str = "value") -> DataFrame:
    """Inverse of TNS-2 into the long form (node position, feature position, value)."""
    a = df.select(*keys, F.posexplode(col).alias(node, "__v"))
    return a.select(*keys, node, F.posexplode("__v").alias(feature, value))


def step_samples(packed: DataFrame, sample_id: str, mask_rate: float, seed: int = 0,
                 features: str = "features") -> DataFrame:
    """SMP-1 + MSK-1/2: per (day, step) sample — masked data, true target and the node mask."""
    s = packed.withColumn("mask", F.transform(F.col("nodes"),
                                              lambda n: geo.sensor_mask(F.col(sample_id), n, mask_rate, seed)))
    data = F.transform(F.col(features), lambda v, i: F.transform(
        v, lambda x: geo.apply_mask(x, F.col("mask")[i]).cast("float")))
    return s.withColumns({"target": F.col(features), "data": data}).drop(features)


def sliding_window_rows(df: DataFrame, group: list[str], step: str, steps_per_group: int,
                        input_len: int, pred_len: int, stride: int = 1) -> DataFrame:
    """SMP-2 + SMP-6 in long form: every row of every window, never across a group.

    Window starts are ``0, stride, …`` up to ``T - L``; each row joins the windows
    ``start <= step < start + L`` via ``explode(sequence)`` (at most L of them).
    Added columns: ``window_start``, ``k`` (offset in the window) and ``part``
    (``input`` for the first ``input_len`` offsets, ``target`` after).
    """
    length = input_len + pred_len
    check_window(steps_per_group, length)
    last = steps_per_group - length
    s = F.col(step)
    lo = F.greatest(F.lit(0), s - (length - 1))
    first = lo + F.pmod(F.lit(stride) - F.pmod(lo, F.lit(stride)), F.lit(stride))
    hi = F.least(F.lit(last), s)
    starts = F.when(first <= hi, F.sequence(first, hi, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    r = df.withColumn("window_start", F.explode(starts))
    k = F.col(step) - F.col("window_start")
    return r.withColumns({"k": k, "part": F.when(k < input_len, F.lit("input")).otherwise(F.lit("target"))})


def tumbling_window_rows(df: DataFrame, step: str, window: int, steps_per_group: int | None = None,
                         drop_remainder_of: Column | None = None) -> DataFrame:
    """SMP-3 / SMP-5 in long form: window id = ``floor(step / L)``, offset ``k``.

    With ``steps_per_group`` the length must divide it (VAL-4, SMP-3).  With
    ``drop_remainder_of`` (the series length S) windows past ``S div L`` are
    dropped (SMP-5).
    """
    if steps_per_group is not None:
        check_window(steps_per_group, window, tumbling=True)
    r = df.withColumns({"window_id": F.floor(F.col(step) / window).cast("bigint"),
                        "k": F.pmod(F.col(step), F.lit(window)).cast("bigint")})
    if drop_remainder_of is not None:
        r = r.filter(F.col("window_id") < F.floor(drop_remainder_of / window))
    return r


def series_sliding_rows(df: DataFrame, step: str, window: int, series_len: Column) -> DataFrame:
    """SMP-4: S - W + 1 windows with stride 1 over one whole series, in long form.

    Each row is replicated into the windows ``max(0, step-W+1) .. min(step, S-W)``;
    grouping by ``window_start`` afterwards spreads the windows over tasks.
    """
    s = F.col(step)
    lo = F.greatest(F.lit(0).cast("bigint"), s - (window - 1))
    hi = F.least(series_len - window, s)
    starts = F.when(lo <= hi, F.sequence(lo.cast("bigint"), hi.cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    r = df.withColumn("window_start", F.explode(starts))
    return r.withColumn("k", F.col(step) - F.col("window_start"))


def windows_to_arrays(rows: DataFrame, keys: list[str], k: str, value: str | Column, input_len: int,
                      out_data: str = "data", out_target: str = "target") -> DataFrame:
    """SMP-6 on arrays: per window the offsets in order, split into data (offsets below ``input_len``) and target.

    A step that is absent from a window leaves its array shorter; it never moves another step across the split.
    """
    v = F.col(value) if isinstance(value, str) else value
    g = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(k).alias("k"), v.alias("v")))).alias("__w"))

    def part(wanted) -> Column:
        return F.transform(F.filter("__w", wanted), lambda e: e["v"])

    return g.select(*keys, part(lambda e: e["k"] < input_len).alias(out_data), part(lambda e: e["k"] >= input_len).alias(out_target))
