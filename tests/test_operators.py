"""Operator unit tests on small hand-made frames (the A9 fixture of FIXTURES.md) and property tests."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import geo, physics as phy, timeaxis as tx
from gridloom.operators import dedup, features, fill, grid, quality, scaffold, tensors

D = dt.datetime(2024, 2, 29)  # a leap day


def ts(h, m=0):
    return D + dt.timedelta(hours=h, minutes=m)


@pytest.fixture()
def day_obs(spark):
    """One day, 3 grids, 10-minute steps 00:00..00:50 with the A9 oddities."""
    rows = []
    for step in range(6):
        for g in range(3):
            if (step, g) in {(2, 1), (3, 1), (3, 2)}:  # a missing step for grid 1, two adjacent ones
                continue
            rows.append((ts(0, 10 * step), g, 20.0 + step, 1000.0, 50.0, 0.0, 1, 10 * step + g))
    rows.append((ts(0, 0), 0, 99.0, 1000.0, 50.0, 0.0, 2, 0))     # conflicting duplicate from a later page
    rows.append((ts(0, 10), 1, 21.0, 1000.0, 50.0, 0.0, 1, 11))    # exact duplicate, same page
    rows.append((ts(0, 5), 0, 20.5, 0.0, 0.0, -1.0, 1, 99))        # off-schedule time, sentinels, negative rain
    rows.append((ts(0, 20), 7, 20.0, 1000.0, 50.0, 0.0, 1, 98))    # grid id above the maximum
    return spark.createDataFrame(rows, "ts timestamp_ntz, grid_id bigint, t double, slp double, rh double, "
                                       "rain double, page bigint, row_ord bigint")


def test_dedup_keeps_first_page(day_obs):
    d = dedup.dedup_keep_first(day_obs, ["ts", "grid_id"], ["page", "row_ord"])
    r = d.filter((F.col("ts") == ts(0)) & (F.col("grid_id") == 0)).collect()
    assert len(r) == 1 and r[0]["t"] == 20.0
    assert d.count() == day_obs.select("ts", "grid_id").distinct().count()


def test_dedup_is_idempotent(day_obs):
    once = dedup.dedup_keep_first(day_obs, ["ts", "grid_id"], ["page", "row_ord"])
    twice = dedup.dedup_keep_first(once, ["ts", "grid_id"], ["page", "row_ord"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_completeness_strict_and_reference_counting(day_obs):
    d = dedup.dedup_keep_first(day_obs, ["ts", "grid_id"], ["page", "row_ord"])
    strict = quality.completeness(d, "ts", "grid_id", max_grid_id=2, step_minutes=10).first()
    assert strict["total_time_points"] == 144
    assert strict["missing_time_points_count"] == 138           # only 00:00..00:50 present
    assert strict["incomplete_time_points_count"] == 2           # 00:20 and 00:30
    assert strict["complete_time_points"] == 4
    assert strict["actual_points"] == 15                         # off-schedule and out-of-range rows excluded
    assert strict["incomplete_time_points"] == {"00:20": 1, "00:30": 2}
    assert "01:00" in strict["missing_time_points"] and "00:00" not in strict["missing_time_points"]
    loose = quality.completeness(d, "ts", "grid_id", max_grid_id=2, step_minutes=10, strict=False).first()
    assert loose["actual_points"] == 17                          # every row counts, as in the reference
    assert loose["incomplete_time_points_count"] == 3            # the off-schedule 00:05 point too


def test_missing_times_and_gap_runs(day_obs):
    d = dedup.dedup_keep_first(day_obs.filter("grid_id <= 2"), ["ts", "grid_id"], ["page", "row_ord"])
    miss = quality.missing_times(d.filter("grid_id = 1"), "ts", 10)
    assert miss.count() == 144 - 4
    runs = quality.gap_runs(miss, 10).orderBy("run_start").collect()
    assert runs[0]["run_start"] == ts(0, 20) and runs[0]["run_length"] == 2 and runs[0]["adjacent"]


def test_sentinels_become_null_and_are_counted(day_obs):
    c = quality.sentinel_counts(day_obs, "ts", ["slp", "rh"]).first()
    assert c["slp_abnormal"] == 1 and c["rh_abnormal"] == 1
    n = quality.sentinel_to_null(day_obs, ["slp", "rh"]).filter(F.col("slp").isNull()).count()
    assert n == 1


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (0.5,), (3.0,)], "x double")
    out = [r[0] for r in df.select(phy.clip("x", 0.0, 1.0)).collect()]
    assert out == [None, 0.0, 0.5, 1.0]


def test_wind_components_round_trip(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 90.0), (2.0, 225.0), (0.0, 10.0)], "s double, d double")
    w = phy.wind_components(df, [("s", "d")]).withColumn("ws", phy.magnitude("s_x", "s_y"))
    assert "s" not in w.columns and "d" not in w.columns
    for r, src in zip(w.collect(), df.collect()):
        assert math.isclose(r["ws"], src["s"], abs_tol=1e-12)
    east = w.collect()[1]
    assert math.isclose(east["s_x"], 5.0) and abs(east["s_y"]) < 1e-12


def test_lon_wrap_and_lat_bound(spark):
    df = spark.createDataFrame([(180.0, 90.0), (181.0, -90.0), (360.0, 0.0), (359.0, 12.5)], "lon double, lat double")
    out = df.select(geo.wrap_lon("lon").alias("lon"), geo.bound_lat("lat").alias("lat")).collect()
    assert [r["lon"] for r in out] == [180.0, -179.0, 0.0, -1.0]
    assert [r["lat"] for r in out] == [89.9999, -89.9999, 0.0, 12.5]


def test_grid_counts():
    assert geo.global_grid_points(5, 5) == (37, 72)
    assert geo.grid_points(54, 73, 3, 135, 1, 1) == (52, 63)
    assert geo.grid_points(10, 170, 0, -170, 5, 5) == (3, 5)    # wraps across the date line
    assert geo.grid_points(10, 0, 0, 360, 5, 5) == (3, 72)      # a 360° span is global


def test_leap_day_calendar_and_regular_timestamps(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 1))], "a date, b date")
    days = df.select(F.explode(tx.calendar("a", "b")).alias("d")).collect()
    assert [r.d for r in days] == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    r = spark.range(3).select(tx.regular_timestamp(F.lit(dt.datetime(2024, 2, 28, 23, 0)).cast("timestamp_ntz"),
                                                   "id", 60 * 24).alias("t")).collect()
    assert [x.t for x in r] == [dt.datetime(2024, 2, 28, 23), dt.datetime(2024, 2, 29, 23), dt.datetime(2024, 3, 1, 23)]


def test_slot_and_mixed_parsing(spark):
    df = spark.createDataFrame([("2013070101",), ("2013070148",)], "s string")
    assert [r[0] for r in df.select(tx.slot_timestamp("s")).collect()] == [
        dt.datetime(2013, 7, 1, 0, 0), dt.datetime(2013, 7, 1, 23, 30)]
    df = spark.createDataFrame([("2016-07-01 02:00:00",), ("2016/07/01 02:15",), ("20160701",), ("junk",)], "s string")
    assert [r[0] for r in df.select(tx.parse_mixed("s")).collect()] == [
        dt.datetime(2016, 7, 1, 2, 0), dt.datetime(2016, 7, 1, 2, 15), dt.datetime(2016, 7, 1), None]


def _series_frame(spark, values):
    rows = [(0, i, None if (v is None or (isinstance(v, float) and math.isnan(v))) else float(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "g int, pos int, x double")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50)), min_size=2, max_size=30))
def test_linear_fill_equals_pandas(spark, values):
    if all(v is None for v in values):
        return
    df = _series_frame(spark, values)
    got = df.select("pos", fill.linear_interpolate("x", ["g"], "pos", "pos").alias("y")).orderBy("pos").collect()
    want = pd.Series([np.nan if v is None else v for v in values], dtype=float).interpolate().ffill().bfill()
    for r, w in zip(got, want):
        assert math.isclose(r["y"], w, rel_tol=1e-9, abs_tol=1e-9)


def test_fill_gate_at_exactly_twenty_percent(spark):
    base = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, None, 10.0]        # 20 % missing → filled
    over = [1.0, None, None, 4.0, 5.0, 6.0, 7.0, 8.0, None, 10.0]       # 30 % missing → left alone
    rain = [-1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]        # filled → whole series clipped
    rows = [(g, i, v) for g, vals in ((0, base), (1, over)) for i, v in enumerate(vals)]
    rows += [(2, i, v) for i, v in enumerate(rain)]
    df = spark.createDataFrame(rows, "g int, pos int, x double").withColumn("rain", F.col("x"))
    out = fill.temporal_fill_linear(df, ["x"], ["g"], "pos", 0.2).orderBy("g", "pos").collect()
    assert [r["x"] for r in out if r["g"] == 0] == [float(i) for i in range(1, 11)]
    assert sum(r["x"] is None for r in out if r["g"] == 1) == 3
    rain_out = fill.temporal_fill_linear(df.filter("g = 2"), ["rain"], ["g"], "pos", 0.2).orderBy("pos").collect()
    assert rain_out[0]["rain"] == 0.0 and rain_out[2]["rain"] == 3.0


def test_mean_field_skips_null_and_drops_back(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, None), (1, 2, 4.0)], "ts int, grid_id int, x double")
    m = features.with_mean_field(df, "ts", ["x"])
    means = m.filter("is_mean_field").collect()
    assert len(means) == 1 and means[0]["x"] == 3.0 and means[0]["grid_id"] is None
    key = lambda r: (r["ts"], r["grid_id"])
    assert sorted(features.drop_mean_field(m).collect(), key=key) == sorted(df.collect(), key=key)


def test_first_non_null_in_order(spark):
    df = spark.createDataFrame([(1, 3, None, 7.0), (1, 1, None, 5.0), (1, 2, 9.0, None), (2, 1, None, None)],
                               "k int, o int, a double, b double")
    out = {r["k"]: r for r in grid.first_non_null(df, ["k"], "o", ["a", "b"]).collect()}
    assert out[1]["a"] == 9.0 and out[1]["b"] == 5.0
    assert out[2]["a"] is None and out[2]["b"] is None


def test_grid_ids_rank_lat_then_lon(spark):
    pts = [(10.0, 5.0), (0.0, 5.0), (5.0, -5.0), (10.0, 5.0)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    ids = {(r["lon"], r["lat"]): r["grid_id"] for r in grid.grid_ids(df).collect()}
    assert ids == {(5.0, -5.0): 0, (0.0, 5.0): 1, (10.0, 5.0): 2}


def test_global_position_matches_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    pos = grid.global_position(df, F.floor(F.col("k") / 97), ["k"], "pos").toPandas()
    pos = pos.sort_values("k").reset_index(drop=True)
    assert (pos["pos"] == np.arange(len(pos))).all()


def test_tail_truncate_keeps_last_rows(spark):
    rows = [(ts(h), float(lon), 0.0) for h in range(3) for lon in range(4)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, lon double, lat double")
    out = grid.tail_truncate(df, "ts", ["lon", "lat"], steps=2, grids=3).collect()
    kept = sorted((r["ts"].hour, r["lon"]) for r in out)
    assert kept == [(1, 2.0), (1, 3.0), (2, 0.0), (2, 1.0), (2, 2.0), (2, 3.0)]


def test_scaffold_generates_every_cell(spark):
    days = spark.createDataFrame([(dt.date(2024, 2, 29),)], "date date")
    sc = scaffold.scaffold(days, 10, 4231)
    assert sc.count() == 144 * 4232


@settings(max_examples=10, deadline=None)
@given(t=st.integers(2, 30), inp=st.integers(1, 5), pred=st.integers(1, 5), stride=st.integers(1, 4))
def test_sliding_window_count(spark, t, inp, pred, stride):
    length = inp + pred
    if length > t:
        with pytest.raises(ValueError):
            tensors.sliding_window_rows(spark.range(1), ["id"], "id", t, inp, pred, stride)
        return
    df = spark.range(t).select(F.lit(0).alias("g"), F.col("id").alias("step"))
    w = tensors.sliding_window_rows(df, ["g"], "step", t, inp, pred, stride)
    starts = w.select("window_start").distinct().count()
    assert starts == (t - length) // stride + 1
    assert w.groupBy("window_start").count().filter(F.col("count") != length).count() == 0


def test_tumbling_windows_partition_rows(spark):
    df = spark.range(24).select(F.col("id").alias("step"))
    w = tensors.tumbling_window_rows(df, "step", 6, steps_per_group=24)
    assert w.count() == 24 and w.select("window_id").distinct().count() == 4
    with pytest.raises(ValueError):
        tensors.tumbling_window_rows(df, "step", 5, steps_per_group=24)
    s = spark.range(11).select(F.col("id").alias("step"))
    dropped = tensors.tumbling_window_rows(s, "step", 4, drop_remainder_of=F.lit(11))
    assert dropped.count() == 8


def test_series_sliding_windows(spark):
    s = spark.range(11).select(F.col("id").alias("step"))
    w = tensors.series_sliding_rows(s, "step", 4, F.lit(11))
    assert w.select("window_start").distinct().count() == 8 and w.count() == 32
    arr = tensors.windows_to_arrays(w, ["window_start"], "k", "step", 3).orderBy("window_start").first()
    assert arr["data"] == [0, 1, 2] and arr["target"] == [3]


def test_pack_and_mask(spark):
    rows = [(0, s, g, float(g), float(10 * s)) for s in range(2) for g in range(3)]
    df = spark.createDataFrame(rows, "d int, step int, g int, a double, b double")
    p = tensors.pack_steps(df, ["d", "step"], "g", ["a", "b"]).orderBy("step").first()
    assert p["features"] == [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]]
    smp = tensors.step_samples(tensors.pack_steps(df, ["d", "step"], "g", ["a", "b"])
                               .withColumn("sid", F.col("step")), "sid", mask_rate=1.0)
    r = smp.first()
    assert all(r["mask"]) and all(x == 0.0 for v in r["data"] for x in v) and r["target"] != r["data"]


def test_air_density_reference_value(spark):
    df = spark.createDataFrame([(15.0, 1013.25, 0.0)], "t double, p double, rh double")
    rho = df.select(phy.air_density("t", "p", "rh")).first()[0]
    assert math.isclose(rho, 101325 / (287.05 * 288.15), rel_tol=1e-12)


def test_relative_humidity_saturated(spark):
    df = spark.createDataFrame([(293.15, 293.15), (293.15, 300.0)], "t double, d double")
    out = [r[0] for r in df.select(phy.relative_humidity("t", "d")).collect()]
    assert math.isclose(out[0], 100.0) and out[1] == 100.0


def test_wall_clock_functions_ignore_session_zone(spark):
    """02:30 on 2001-04-01 does not exist in New York; NTZ wall clocks must not move."""
    from gridloom.plans.present import present

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2001-04-01 02:30:00", "20010401_023000")], "a string, b string")
        r = df.select(tx.parse_mixed("a").alias("p"), tx.parse_compact_time("b").alias("c")).select(
            "p", "c", tx.time_label("p").alias("lbl"), tx.compact_time("p").alias("cmp"),
            tx.trunc_hour("p").alias("h"))
        row = present(r).first()
        assert row["p"] == "2001-04-01 02:30:00" and row["c"] == "2001-04-01 02:30:00"
        assert row["lbl"] == "02:30" and row["cmp"] == "20010401_023000" and row["h"] == "2001-04-01 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 12), st.integers(0, 3)), min_size=1, max_size=25))
def test_day_overlap_sweep_equals_direct_form(spark, spans):
    """The sweep (counts + record spans) gives what expanding every span into its days gives."""
    from gridloom.operators import intervals

    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(days=s, hours=h), base + dt.timedelta(days=s + n, hours=h))
            for i, (s, n, h) in enumerate(spans)]
    df = spark.createDataFrame(rows, "page bigint, s timestamp_ntz, e timestamp_ntz")
    got = {r["date"]: (r["n_spans"], r["page_out"]) for r in
           intervals.day_overlap(df.withColumn("page_out", F.col("page")), "s", "e", "page", ["page_out"]).collect()}
    direct = intervals.span_days(df, "s", "e").groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("page", F.struct("s", "page")).alias("first"))
    want = {r["date"]: (r["n"], r["first"]) for r in direct.collect()}
    assert got == want


def test_align_keeps_every_observed_day(spark):
    """A day with only off-schedule rows and one with only out-of-range ids are days of NULL cells."""
    rows = [("2024-01-01 00:00:00", 0, 1.0), ("2024-01-02 00:07:00", 0, 2.0), ("2024-01-03 00:00:00", 9, 3.0), (None, 0, 4.0)]
    d = spark.createDataFrame(rows, "t string, grid_id bigint, v double").withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    got = scaffold.align(d, None, 60, 1)
    per_day = {str(r["date"]): (r["n"], r["seen"]) for r in got.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("seen")).collect()}
    assert per_day == {"2024-01-01": (48, 1), "2024-01-02": (48, 0), "2024-01-03": (48, 0)}
