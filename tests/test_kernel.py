"""Tiled kernel inverse, error channel of the fills, smoothing splines and merged cubes."""

import datetime as dt

import numpy as np
import pytest

from gridloom.operators import grid, interp, kernel, smoothing
from gridloom.operators.interp import Method


def _grid(spark, n, seed=0):
    rnd = np.random.default_rng(seed)
    side = int(np.ceil(np.sqrt(n)))
    rows = [(3 * i + 1, 113 + 0.01 * (i % side) + 0.001 * rnd.random(), 22 + 0.01 * (i // side)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "grid_id bigint, lon_center double, lat_center double")


def _dense(rows, values):
    return interp.multiquadric_fill(interp.zscore(np.array([r[1:] for r in rows])), values)


@pytest.mark.parametrize("n,block", [(1, 4), (7, 3), (60, 60), (100, 32)])
def test_tiled_inverse_fills_like_the_dense_solve(spark, n, block):
    rows, df = _grid(spark, n)
    inverse = kernel.kernel_inverse(df, block=block)
    assert (inverse.size, inverse.block) == (n, block)
    rnd = np.random.default_rng(n)
    values = rnd.normal(size=(n, 2))
    if n > 1:
        values[rnd.choice(n, max(1, n // 6), replace=False)] = np.nan
        got = kernel.fill_from_inverse(values, kernel._Rows(inverse.folder, n, block).take)
        assert np.allclose(got, _dense(rows, values), atol=1e-5)
    b = kernel._Rows(inverse.folder, n, block).take(np.arange(n))
    xy = interp.zscore(np.array([r[1:] for r in rows]))
    a = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1) / 4 + 1) - 1e-6 * np.eye(n)
    assert np.abs(b @ a - np.eye(n)).max() < 1e-6


def test_tiled_pass_equals_dense_pass_and_reports_bad_times(spark):
    rows, df = _grid(spark, 20)
    rnd = np.random.default_rng(5)
    cells = []
    for h in range(6):
        gaps, other = set(rnd.choice(20, 3, replace=False).tolist()), set(rnd.choice(20, 4 + 2 * (h == 2), replace=False).tolist())
        cells += [(dt.datetime(2024, 1, 1, h), r[0], None if k in gaps else float(rnd.normal()), None if k in other else float(rnd.normal()), h)
                  for k, r in enumerate(rows) if not (h == 4 and k == 0)]
    obs = spark.createDataFrame(cells, "ts timestamp_ntz, grid_id bigint, a double, b double, h int").join(df, "grid_id")
    whole = obs.filter("h != 4")
    inverse = kernel.kernel_inverse(df, block=6)
    key = lambda r: (r["ts"], r["grid_id"])
    dense = {key(r): (r["a"], r["b"]) for r in interp.spatial_pass(whole, ["a", "b"]).collect()}
    tiled = {key(r): (r["a"], r["b"]) for r in kernel.spatial_pass_tiled(whole, ["a", "b"], inverse).collect()}
    assert dense.keys() == tiled.keys()
    for k in dense:
        assert all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-5) for x, y in zip(dense[k], tiled[k]))
    assert any(r[1] is None for r in tiled.values())  # the hour with too many gaps in b
    out = kernel.spatial_pass_tiled(obs, ["a", "b"], inverse, error_col="why")
    assert out.count() == obs.count()
    bad = [tuple(r) for r in interp.fill_failures(out, ["ts"], "why").collect()]
    assert bad == [(dt.datetime(2024, 1, 1, 4), "ValueError: 19 of 20 nodes in 19 rows")]
    assert out.filter("why is null and h != 2 and a is null").count() == 0
    with pytest.raises(Exception, match="19 of 20 nodes"):
        kernel.spatial_pass_tiled(obs, ["a", "b"], inverse).collect()


def test_one_bad_time_leaves_the_others(spark):
    """A node without coordinates in one hour: that hour is reported, the rest is filled and the chain goes on."""
    rows, _ = _grid(spark, 12)
    cells = [(dt.date(2024, 1, d), dt.datetime(2024, 1, d, h), r[0], None if (d, h) == (1, 3) and k == 2 else r[1], r[2],
              None if k == h else float(d + h + k)) for d in (1, 2) for h in range(6) for k, r in enumerate(rows)]
    df = spark.createDataFrame(cells, "date date, ts timestamp_ntz, grid_id bigint, lon_center double, lat_center double, v double")
    out = interp.spatial_pass(df, ["v"], error_col="why")
    assert [r["ts"].hour for r in interp.fill_failures(out, ["ts"], "why").collect()] == [3]
    assert [(r["ts"].hour, r["grid_id"]) for r in out.filter("v is null").collect()] == [(3, rows[3][0])]
    done, status = interp.st_fill(df, {"v": Method("cubic")})
    got = {r["date"].day: (r["success"], r["reason"]) for r in status.collect()}
    assert got == {1: (True, "ValueError: a node has no coordinates"), 2: (True, None)}  # the temporal pass fills what is left
    assert done.count() == len(cells) and done.columns == df.columns
    same = interp.temporal_pass(df, {"v": Method("linear")}, ["date", "grid_id"], "ts", 0.5, error_col="why")
    assert "why" in same.columns and same.filter("why is not null").count() == 0


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_smoothing_meets_its_target(k):
    rnd = np.random.default_rng(k)
    for n in (15, 40, 90):
        x = np.sort(rnd.choice(np.arange(3.0 * n), n, replace=False))
        y = 3 * np.sin(x / 7) + rnd.normal(size=n)
        straight = ((np.polyval(np.polyfit(x, y, k), x) - y) ** 2).sum()
        for target in (0.2 * n, 0.6 * n, 1.0 * n, 2.0 * straight):
            residual = ((smoothing.smoothing_spline(x, y, x, k, target) - y) ** 2).sum()
            if straight <= target:
                assert residual == pytest.approx(straight, rel=1e-6)  # the polynomial of degree k
            else:
                assert residual == pytest.approx(target, rel=3e-3)


def test_smoothing_limits():
    x = np.arange(30.0)
    for k in (1, 2, 3):
        y = np.polyval(np.arange(1, k + 2), x / 10)
        assert np.allclose(smoothing.smoothing_spline(x, y, x + 0.0, k, 5.0), y)
    y = np.sin(x)
    assert np.allclose(smoothing.smoothing_spline(x, y, x, 3, 0.0), y)
    assert np.allclose(smoothing.smoothing_spline(x[:3], y[:3], x[:3], 3, 9.0), y[:3])
    assert np.isnan(smoothing.smoothing_spline(x, y, np.array([-1.0, 31.0]), 2, 3.0)).all()
    rough = np.abs(np.diff(smoothing.smoothing_spline(x, y, x, 3, 0.01), 3)).sum()
    assert np.abs(np.diff(smoothing.smoothing_spline(x, y, x, 3, 8.0), 3)).sum() < rough
    v = np.where(np.arange(30) % 9 == 4, np.nan, 10 + np.sin(x) + np.random.default_rng(0).normal(size=30))
    interpolated = interp.fill_series(v, Method("spline", 2), 0.2, False)
    smoothed = interp.fill_series(v, Method("spline", 2, smoothing=1.0), 0.2, False)
    known = ~np.isnan(v)
    assert np.array_equal(interpolated[known], v[known]) and np.array_equal(smoothed[known], v[known])
    assert not np.allclose(interpolated[~known], smoothed[~known]) and np.isfinite(smoothed).all()


def test_merged_cubes_report_conflicts(spark):
    a = spark.createDataFrame([(1, 0.0, 1.0, None), (2, 0.0, 2.0, 5.0), (2, 0.0, 2.5, None)], "t int, x double, u double, v double")
    b = spark.createDataFrame([(1, 0.0, 1.05, 7.0), (3, 0.0, 9.0, 8.0)], "t int, x double, u double, v double")
    c = spark.createDataFrame([(1, 0.0, 3.0)], "t int, x double, w double")
    got = {r["t"]: (r["u"], r["v"], r["w"], r["conflicts"]) for r in grid.merge_cubes([a, b, c], ["t", "x"]).collect()}
    assert got == {1: (1.0, 7.0, 3.0, ["u"]), 2: (2.0, 5.0, None, ["u"]), 3: (9.0, 8.0, None, [])}
    near = {r["t"]: r["conflicts"] for r in grid.merge_cubes([a, b], ["t", "x"], tolerance=0.1).collect()}
    assert near == {1: [], 2: ["u"], 3: []}
    assert grid.merge_cubes([a.filter("false"), b.filter("false")], ["t", "x"]).count() == 0
