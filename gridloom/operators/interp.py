"""Group-map gap filling: cubic / spline in time (INT-2/3), radial basis in space (INT-4),
and the chained space-time fill (INT-5).

Spark ships one bounded group per task call: a (day, grid) series of T steps for
the temporal pass, one timestamp's G grid cells for the spatial pass.  The NumPy
code below is the per-group solver; grouping, shuffling and retries are Spark's.
SciPy is not available, so the interpolating B-spline and the multiquadric
radial-basis solve are written out with NumPy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.fill import temporal_fill_linear
from gridloom.session import cut_lineage

# ---------------------------------------------------------------- 1-D splines


def spline_knots(x: np.ndarray, k: int) -> np.ndarray:
    """Knot vector of an interpolating spline of degree k through sites x.

    Odd k: not-a-knot (interior knots at the sites, the k-1 sites nearest each end
    left out).  Even k: interior knots at the midpoints between sites, the k/2
    midpoints nearest each end left out.  k = 1: knots at the sites (broken line).
    With fewer than k + 1 sites the caller uses degree (sites - 1).
    """
    x = np.asarray(x, dtype=float)
    if k == 1:
        inner = x[1:-1]
    elif k % 2 == 1:
        m = (k + 1) // 2
        inner = x[m:-m]
    elif 1 < k <= 5:
        inner = ((x[1:] + x[:-1]) / 2.0)[k // 2:len(x) - 1 - k // 2]
    else:
        raise ValueError(f"unsupported spline degree {k}")
    return np.r_[(x[0],) * (k + 1), inner, (x[-1],) * (k + 1)]


def bspline_basis(t: np.ndarray, k: int, x: np.ndarray) -> np.ndarray:
    """Matrix of the ``len(t)-k-1`` B-spline basis functions of degree k at points x (Cox–de Boor)."""
    x = np.asarray(x, dtype=float)
    nint = len(t) - 1
    b = np.zeros((len(x), nint))
    for i in range(nint):
        b[:, i] = (t[i] <= x) & (x < t[i + 1])
    # the right end belongs to the last non-empty interval
    last = max(i for i in range(nint) if t[i] < t[i + 1])
    at_end = x == t[-1]
    b[at_end, :] = 0.0
    b[at_end, last] = 1.0
    for d in range(1, k + 1):
        nb = np.zeros((len(x), nint - d))
        for i in range(nint - d):
            left = t[i + d] - t[i]
            right = t[i + d + 1] - t[i + 1]
            term = np.zeros(len(x))
            if left > 0:
                term += (x - t[i]) / left * b[:, i]
            if right > 0:
                term += (t[i + d + 1] - x) / right * b[:, i + 1]
            nb[:, i] = term
        b = nb
    return b


def interpolate_spline(x_known: np.ndarray, y_known: np.ndarray, x_new: np.ndarray, k: int) -> np.ndarray:
    """Interpolating spline of degree k (reduced when there are too few sites); NaN outside the sites."""
    x_known = np.asarray(x_known, dtype=float)
    y_known = np.asarray(y_known, dtype=float)
    x_new = np.asarray(x_new, dtype=float)
    out = np.full(len(x_new), np.nan)
    n = len(x_known)
    if n == 0:
        return out
    if n == 1:
        out[x_new == x_known[0]] = y_known[0]
        return out
    k = min(k, n - 1)
    t = spline_knots(x_known, k)
    coef = np.linalg.solve(bspline_basis(t, k, x_known), y_known)
    inside = (x_new >= x_known[0]) & (x_new <= x_known[-1])
    if inside.any():
        out[inside] = bspline_basis(t, k, x_new[inside]) @ coef
    return out


# ---------------------------------------------------------------- routing


def split_by_need(df: DataFrame, keys: list[str], columns: list[str], threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows of groups that have something to fill, and rows of groups that do not.

    A group needs work when some column has a NULL share in ``(0, threshold]``.
    The share is a window over the group key, so the data are shuffled once by
    the key; the grouped map that follows on the same key reuses that
    partitioning, and the other branch bypasses Python entirely.
    """
    w = Window.partitionBy(*keys)
    need = F.lit(False)
    for c in columns:
        share = F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).over(w)
        need = need | ((share > 0) & (share <= threshold))
    flagged = df.withColumn("__need", need)
    return (flagged.filter("__need").drop("__need"), flagged.filter(~F.col("__need")).drop("__need"))


def guarded(todo: DataFrame, keys: list[str], solve: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType,
            done: DataFrame, error_col: str | None = None) -> DataFrame:
    """``solve`` per group of ``todo``, together with ``done``.

    With ``error_col`` a group whose solve fails comes back as it was (the columns of ``schema``), with the reason
    in that column, and the job goes on (Q17); an earlier reason in the column stays.  Without it the error is raised.
    """
    if error_col is None:
        return todo.groupBy(*keys).applyInPandas(solve, schema).unionByName(done)
    names = schema.names
    wide = schema if error_col in names else T.StructType([*schema.fields, T.StructField(error_col, T.StringType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            out = solve(pdf.copy())
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as problem:
            out = pdf[names].copy()
            out[error_col] = f"{type(problem).__name__}: {problem}"
            return out
        if error_col not in names:
            out[error_col] = None
        return out

    whole = done if error_col in names else done.withColumn(error_col, F.lit(None).cast("string"))
    return todo.groupBy(*keys).applyInPandas(run, wide).unionByName(whole)


def fill_failures(filled: DataFrame, keys: list[str], error_col: str) -> DataFrame:
    """(keys, reason) of the groups whose solve failed."""
    return filled.filter(F.col(error_col).isNotNull()).groupBy(*keys).agg(F.min(error_col).alias("reason"))


# ---------------------------------------------------------------- temporal pass


@dataclass(frozen=True)
class Method:
    """Per-column fill method: 'linear', 'cubic' or 'spline' (with ``order``).

    ``smoothing`` is for splines: None interpolates the known values; a number allows a residual sum of
    squares of that much per known value (1.0 is the usual default of a smoothing spline).
    """

    method: str = "linear"
    order: int = 3
    smoothing: float | None = None

    @property
    def degree(self) -> int:
        return {"linear": 1, "cubic": 3}.get(self.method, self.order)


def fill_series(values: np.ndarray, method: Method, threshold: float, clip_zero: bool) -> np.ndarray:
    """One column of one series (positions 0..n-1): gate, interpolate, carry edges, clip."""
    v = np.asarray(values, dtype=float)
    nan = np.isnan(v)
    if not nan.any() or nan.sum() / len(v) > threshold:
        return v
    pos = np.arange(len(v), dtype=float)
    if method.smoothing is None:
        est = interpolate_spline(pos[~nan], v[~nan], pos, method.degree)
    else:
        from gridloom.operators.smoothing import smoothing_spline  # it builds on this module

        est = smoothing_spline(pos[~nan], v[~nan], pos, method.degree, method.smoothing * (~nan).sum())
    s = pd.Series(est).ffill().bfill().to_numpy()
    out = v.copy()
    out[nan] = s[nan]
    if clip_zero:
        out = np.where(out < 0, 0.0, out)
    return out


def temporal_pass(df: DataFrame, methods: dict[str, Method], series_keys: list[str], order: str = "ts",
                  threshold: float = 0.2, clip_prefix: str = "rain", error_col: str | None = None) -> DataFrame:
    """INT-1: linear columns with window functions; cubic/spline columns in one grouped map per series.

    ``error_col``: see ``guarded``.
    """
    linear = [c for c, m in methods.items() if m.method == "linear"]
    curved = {c: m for c, m in methods.items() if m.method != "linear"}
    out = temporal_fill_linear(df, linear, series_keys, order, threshold, clip_prefix) if linear else df
    if not curved:
        return out if error_col is None or error_col in out.columns else out.withColumn(error_col, F.lit(None).cast("string"))
    schema = out.schema

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        for c, m in curved.items():
            pdf[c] = fill_series(pdf[c].to_numpy(dtype=float, na_value=np.nan), m, threshold,
                                 c.lower().startswith(clip_prefix))
        return pdf

    todo, done = split_by_need(out, series_keys, list(curved), threshold)
    return guarded(todo, series_keys, per_series, schema, done, error_col)


# ---------------------------------------------------------------- spatial pass


def zscore(a: np.ndarray) -> np.ndarray:
    mu = a.mean(axis=0)
    sd = a.std(axis=0)
    sd[sd == 0] = 1.0
    return (a - mu) / sd


def multiquadric_fill(coords: np.ndarray, values: np.ndarray, epsilon: float = 2.0,
                      smooth: float = 1e-6) -> np.ndarray:
    """Fill NaNs of several columns sharing one null pattern with a multiquadric radial basis.

    ``values`` is (nodes, columns) with the same NaN rows in every column; the
    system ``(Φ - smooth·I) w = y`` is solved once for all columns.
    """
    nan = np.isnan(values[:, 0])
    known, unknown = coords[~nan], coords[nan]

    def phi(a, b):
        # squared distances without an (n, m, 2) intermediate: |a|^2 + |b|^2 - 2 a.b
        r2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return np.sqrt(np.maximum(r2, 0.0) / (epsilon * epsilon) + 1.0)

    a = phi(known, known) - np.eye(len(known)) * smooth
    w = np.linalg.solve(a, values[~nan])
    out = values.copy()
    out[nan] = phi(unknown, known) @ w
    return out


def spatial_pass(df: DataFrame, columns: list[str], ts: str = "ts", lon: str = "lon_center",
                 lat: str = "lat_center", threshold: float = 0.2, epsilon: float = 2.0,
                 smooth: float = 1e-6, error_col: str | None = None) -> DataFrame:
    """INT-4: per timestamp, fill each column's NULL cells from the known ones (z-scored coordinates).

    A column with no gap, or with more than ``threshold`` missing, is left alone.
    Columns with the same null pattern share one factorisation.  One task solves a timestamp densely;
    ``kernel.spatial_pass_tiled`` is for grids that this is too large for.  ``error_col``: see ``guarded``.
    """
    schema = df.schema

    def per_time(pdf: pd.DataFrame) -> pd.DataFrame:
        present = [c for c in columns if c in pdf.columns]
        if not present:
            return pdf
        vals = pdf[present].to_numpy(dtype=float, na_value=np.nan)
        nan = np.isnan(vals)
        share = nan.mean(axis=0)
        todo = [j for j in range(len(present)) if 0 < share[j] <= threshold and (~nan[:, j]).any()]
        if not todo:
            return pdf
        xy = zscore(pdf[[lon, lat]].to_numpy(dtype=float))
        patterns: dict[bytes, list[int]] = {}
        for j in todo:
            patterns.setdefault(nan[:, j].tobytes(), []).append(j)
        for cols in patterns.values():
            if not np.isfinite(xy).all():
                raise ValueError("a node has no coordinates")
            vals[:, cols] = multiquadric_fill(xy, vals[:, cols], epsilon, smooth)
            if not np.isfinite(vals[:, cols]).all():
                raise ValueError("the solution is not finite")
        pdf = pdf.copy()
        for j, c in enumerate(present):
            pdf[c] = vals[:, j]
        return pdf

    todo, done = split_by_need(df, [ts], columns, threshold)
    return guarded(todo, [ts], per_time, schema, done, error_col)


# ---------------------------------------------------------------- space-time chain


def st_fill(df: DataFrame, methods: dict[str, Method], day: str = "date", grid: str = "grid_id", ts: str = "ts",
            lon: str = "lon_center", lat: str = "lat_center", space_threshold: float = 0.2,
            time_threshold: float = 0.2, rounds: int = 2,
            checkpoint: bool = True) -> tuple[DataFrame, DataFrame]:
    """INT-5: space pass, then time pass; a second round for what is still missing; success flag per day.

    Each pass only writes NULL cells (the rain clip only runs where a series was
    filled), so running the passes on every day gives the same result as the
    reference's early exit for complete days.  After each round the lineage is
    cut with a reliable checkpoint in the shared checkpoint folder.  Days that
    are still incomplete are dropped; the status reports every day, with the reason of a solve
    that failed (its cells stay as they were, all others are filled).
    """
    cols = list(methods)
    any_null = F.greatest(*[F.col(c).isNull() for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNull()
    done = None
    todo = df
    for _ in range(rounds):
        todo = spatial_pass(todo, cols, ts, lon, lat, space_threshold, error_col="fill_error")
        todo = temporal_pass(todo, methods, [day, grid], ts, time_threshold, error_col="fill_error")
        if checkpoint:
            todo = cut_lineage(todo)
        # days without a gap left are final; only the others go round again (the reference's early exit)
        gap = F.max(any_null.cast("int")).over(Window.partitionBy(day)) > 0
        flagged = todo.withColumn("__gap", gap)
        finished = flagged.filter(~F.col("__gap")).drop("__gap")
        done = finished if done is None else done.unionByName(finished)
        todo = flagged.filter("__gap").drop("__gap")
    out = done.unionByName(todo)
    status = out.groupBy(day).agg((~F.bool_or(any_null)).alias("success"), F.min("fill_error").alias("reason"))
    return done.drop("fill_error"), status
