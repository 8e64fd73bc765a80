"""Numeric checks of the group-map fills against independent NumPy computations."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators import interp
from gridloom.operators.interp import Method


@pytest.mark.parametrize("k", [1, 2, 3])
def test_spline_reproduces_polynomials_of_its_degree(k):
    rng = np.random.default_rng(k)
    x = np.sort(rng.choice(np.arange(40.0), size=15, replace=False))
    coef = rng.normal(size=k + 1)
    y = np.polyval(coef, x)
    xn = np.linspace(x[0], x[-1], 57)
    got = interp.interpolate_spline(x, y, xn, k)
    assert np.allclose(got, np.polyval(coef, xn), atol=1e-7 * max(1, np.abs(y).max()))


def test_spline_passes_through_sites_and_is_nan_outside():
    x = np.array([2.0, 3.0, 5.0, 8.0, 9.0, 12.0])
    y = np.sin(x)
    for k in (2, 3):
        assert np.allclose(interp.interpolate_spline(x, y, x, k), y)
    out = interp.interpolate_spline(x, y, np.array([0.0, 13.0]), 3)
    assert np.isnan(out).all()


def test_cubic_not_a_knot_against_direct_system():
    """Solve the not-a-knot cubic spline through its second-derivative system and compare."""
    x = np.array([0.0, 1.0, 3.0, 4.0, 7.0, 8.0, 10.0])
    y = np.array([1.0, -2.0, 0.5, 3.0, 2.0, -1.0, 0.0])
    n, h = len(x), np.diff(x)
    a = np.zeros((n, n))
    r = np.zeros(n)
    a[0, :3] = [h[1], -(h[0] + h[1]), h[0]]
    a[-1, -3:] = [h[-1], -(h[-2] + h[-1]), h[-2]]
    for i in range(1, n - 1):
        a[i, i - 1:i + 2] = [h[i - 1], 2 * (h[i - 1] + h[i]), h[i]]
        r[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, r)
    xn = np.linspace(0, 10, 41)
    i = np.clip(np.searchsorted(x, xn, side="right") - 1, 0, n - 2)
    hi = h[i]
    want = (m[i] * (x[i + 1] - xn) ** 3 / (6 * hi) + m[i + 1] * (xn - x[i]) ** 3 / (6 * hi)
            + (y[i] / hi - m[i] * hi / 6) * (x[i + 1] - xn) + (y[i + 1] / hi - m[i + 1] * hi / 6) * (xn - x[i]))
    assert np.allclose(interp.interpolate_spline(x, y, xn, 3), want)


def test_fill_series_gate_edges_and_clip():
    v = np.array([np.nan, 1.0, 2.0, np.nan, 4.0, 5.0, 6.0, 7.0, 8.0, np.nan])
    out = interp.fill_series(v, Method("cubic"), 0.3, False)
    assert np.allclose(out, [1, 1, 2, 3, 4, 5, 6, 7, 8, 8])
    same = interp.fill_series(v, Method("cubic"), 0.2, False)       # 30 % missing > 20 %
    assert np.isnan(same).sum() == 3
    neg = np.array([-1.0, np.nan, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0])
    assert interp.fill_series(neg, Method("linear"), 0.2, True)[0] == 0.0


def test_multiquadric_reproduces_known_values():
    rng = np.random.default_rng(0)
    xy = rng.normal(size=(60, 2))
    vals = np.sin(xy[:, :1]) + xy[:, 1:] ** 2
    holes = vals.copy()
    holes[::7] = np.nan
    filled = interp.multiquadric_fill(xy, holes.copy())
    known = ~np.isnan(holes[:, 0])
    assert np.allclose(filled[known], vals[known])
    # the interpolant evaluated at a known node reproduces it (smooth 1e-6)
    phi = lambda a, b: np.sqrt((np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1)) / 2.0) ** 2 + 1)
    w = np.linalg.solve(phi(xy[known], xy[known]) - np.eye(known.sum()) * 1e-6, vals[known])
    assert np.allclose(phi(xy[~known], xy[known]) @ w, filled[~known])


def test_spark_temporal_pass_matches_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    series = {}
    for g in range(4):
        v = np.cumsum(rng.normal(size=24))
        v[rng.choice(24, size=4, replace=False)] = np.nan
        series[g] = v
        rows += [(g, s, None if np.isnan(x) else float(x)) for s, x in enumerate(v)]
    df = spark.createDataFrame(rows, "g int, ts int, x double")
    out = interp.temporal_pass(df, {"x": Method("cubic")}, ["g"], "ts", 0.2).toPandas()
    for g, v in series.items():
        got = out[out.g == g].sort_values("ts")["x"].to_numpy()
        assert np.allclose(got, interp.fill_series(v, Method("cubic"), 0.2, False))


def test_spark_spatial_pass_matches_numpy(spark):
    rng = np.random.default_rng(5)
    lon, lat = rng.uniform(113, 114, 30), rng.uniform(22, 23, 30)
    x = np.sin(lon) + lat
    x[[3, 11, 20]] = np.nan
    pdf = pd.DataFrame({"ts": 1, "g": np.arange(30), "lon_center": lon, "lat_center": lat, "x": x})
    df = spark.createDataFrame(pdf.astype({"ts": "int64"})).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    out = interp.spatial_pass(df, ["x"], "ts", "lon_center", "lat_center", 0.2).toPandas().sort_values("g")
    want = interp.multiquadric_fill(interp.zscore(np.c_[lon, lat]), x[:, None].copy())[:, 0]
    assert np.allclose(out["x"].to_numpy(), want)
    assert not math.isnan(out["x"].iloc[3])


def test_spline_of_every_order_reproduces_polynomials():
    from gridloom.operators import interp

    x = np.array([0.0, 1.0, 2.5, 4.0, 5.0, 7.0, 8.0, 9.5])
    new = np.linspace(0, 9.5, 23)
    for k in range(1, 6):
        p = np.poly1d(np.arange(1, k + 2)[::-1] / 7.0)
        assert np.allclose(interp.interpolate_spline(x, p(x), new, k), p(new), atol=1e-6)
        assert np.allclose(interp.interpolate_spline(x[:5], x[:5] ** 2, x[:5], k), x[:5] ** 2)  # few sites: lower degree
