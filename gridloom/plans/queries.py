"""Queries over the driver's tables, one per operator group of the inventory.

Each query is ``(spark, base_dir) -> DataFrame`` and runs over whole tables.
Results pass through ``present`` so that they compare cleanly with the SQL
oracle in ``gridloom.plans.oracle`` (same column names, bigint / rounded double /
string times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geo
from gridloom.functions import physics as phy
from gridloom.functions import timeaxis as tx
from gridloom.operators import (dedup, features, fill, grid, interp, intervals, joins, kernel, moments, quality,
                                scaffold, spatial, tensors)
from gridloom.operators.interp import Method
from gridloom.sources.schemas import FLOW_CELLS
from gridloom.plans import views
from gridloom.sources import pages
from gridloom.sources.tables import read_table
from gridloom.plans.present import map_text, present
from gridloom.session import cut_lineage

HOURLY = 60


def _obs_dedup(spark: SparkSession, base: str, n_grids: int = 4) -> DataFrame:
    o = views.with_page_span(views.obs(spark, base, n_grids))
    d = dedup.dedup_keep_first(o, ["ts", "grid_id"], ["span_start", "page", "row_ord"])
    return d.drop("span_start")


def q01_completeness_daily(spark: SparkSession, base: str) -> DataFrame:
    """WIN-1 + AGG-2 + AGG-3: keep-first dedup of hourly cells, then the per-day completeness report
    (points, missing and incomplete points with their lists, expected and actual cells, ratio)."""
    d = _obs_dedup(spark, base, 4)
    rep = quality.completeness(d, "ts", "grid_id", max_grid_id=3, step_minutes=HOURLY)
    rep = rep.withColumns({
        "missing_time_points": F.array_join("missing_time_points", ","),
        "incomplete_time_points": map_text(F.col("incomplete_time_points")),
    })
    return present(rep)


def q02_dedup_keep_first(spark: SparkSession, base: str) -> DataFrame:
    """WIN-1: one row per (hour, grid), the first by (page span start, page, row)."""
    return present(_obs_dedup(spark, base, 4))


def q03_missing_times(spark: SparkSession, base: str) -> DataFrame:
    """DT-1 + JN-6: scheduled hours of each grid's days that have no observation."""
    d = _obs_dedup(spark, base, 8)
    return present(quality.missing_times(d, "ts", HOURLY, by=["grid_id"]))


def q04_gap_runs(spark: SparkSession, base: str) -> DataFrame:
    """WIN-2: runs of consecutive missing hours per grid and day, flagged when adjacent."""
    d = _obs_dedup(spark, base, 8)
    miss = quality.missing_times(d, "ts", HOURLY, by=["grid_id"])
    return present(quality.gap_runs(miss, HOURLY, by=["grid_id"]))


def q05_scaffold_join(spark: SparkSession, base: str) -> DataFrame:
    """JN-1 + JN-2 + JN-3 + PRJ-4: observations on the generated (hour × grid) scaffold with grid
    bounds and centres."""
    d = _obs_dedup(spark, base, 8).drop("page", "row_ord")
    return present(scaffold.align(d, views.grids(spark, base, 8), HOURLY, max_grid_id=7))


def q06_completeness_filter(spark: SparkSession, base: str) -> DataFrame:
    """FLT-3: rows of the days whose completeness ratio reaches 0.95."""
    d = _obs_dedup(spark, base, 4)
    rep = quality.completeness(d, "ts", "grid_id", max_grid_id=3, step_minutes=HOURLY)
    kept, _ = quality.completeness_filter(d, rep, "ts", 0.95)
    return present(kept)


def q07_missing_pages(spark: SparkSession, base: str) -> DataFrame:
    """JN-8 + STR-1: page numbers 1..max absent from the downloaded set.

    Each order's line items stand for one downloaded page file; orders without line
    items are the pages that never arrived.
    """
    li = read_table(spark, base, "lineitem", ["l_orderkey"])
    names = li.select(F.format_string("page%d_rows10000_x.csv", F.col("l_orderkey")).alias("file_name")).distinct()
    return present(quality.missing_numbers(names.select(tx.page_number("file_name").alias("page")), "page"))


def _order_dates(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("date"))


def q08_missing_dates(spark: SparkSession, base: str) -> DataFrame:
    """JN-7 + DT-3: calendar dates between the first and last order date with no orders."""
    return present(quality.missing_dates(_order_dates(spark, base)))


def q09_chunk_plan(spark: SparkSession, base: str) -> DataFrame:
    """DT-4 + AGG-11: 15-day chunks from the first date; per chunk the missing days grouped by month."""
    dates = _order_dates(spark, base)
    bounds = dates.agg(F.min("date").alias("s"), F.max("date").alias("e"))
    return present(quality.chunk_groups(quality.missing_dates(dates), bounds.select("s").scalar(), bounds.select("e").scalar(), 15))


def q10_span_overlap(spark: SparkSession, base: str) -> DataFrame:
    """FLT-2 + JN-5 + SNK-9: per calendar day, the page files (orders) whose span overlaps it.

    Counts come from a sweep over span boundaries and the first file by (span
    start, page) — the file the daily split reads first — from the "record"
    spans, so the work is spans + covered days, not the sum of span lengths.
    """
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_shipdate"])
    spans = li.groupBy(F.col("l_orderkey").alias("page")).agg(
        F.min("l_shipdate").alias("span_start"), F.max("l_shipdate").alias("span_end"))
    named = spans.withColumn("file_name", pages.page_name(F.col("page"), F.col("span_start"), F.col("span_end")))
    # one row per file: materialised once in the shared checkpoint folder, read by both sweeps
    named = cut_lineage(named)
    out = intervals.day_overlap(named, "span_start", "span_end", "page", ["file_name"])
    return present(out.select("date", F.col("n_spans").alias("n_files"), F.col("file_name").alias("first_file")))


def q11_sentinel_null(spark: SparkSession, base: str) -> DataFrame:
    """FLT-7 + AGG-12: zero pressure / humidity counted per day, then turned into NULL."""
    d = _obs_dedup(spark, base, 4)
    counts = quality.sentinel_counts(d, "ts", ["slp", "rh"])
    nulled = quality.sentinel_to_null(d, ["slp", "rh"])
    after = nulled.groupBy(F.to_date("ts").alias("date")).agg(
        F.count("slp").alias("slp_valid"), F.count("rh").alias("rh_valid"),
        F.sum("slp").alias("slp_sum"), F.sum("rh").alias("rh_sum"))
    return present(counts.join(after, "date"))


def _filled_input(spark: SparkSession, base: str, n_grids: int) -> DataFrame:
    d = _obs_dedup(spark, base, n_grids).drop("page", "row_ord")
    d = quality.sentinel_to_null(d, ["slp", "rh"])
    return scaffold.align(d, None, HOURLY, max_grid_id=n_grids - 1)


FILL_COLS = ["t", "rh", "slp", "speed", "dir", "rain"]


def q12_linear_fill(spark: SparkSession, base: str) -> DataFrame:
    """AGG-10 + WIN-3 + WIN-6 + PHY-6 on 4 grids: linear gaps, edge carry, rain clipped at 0."""
    a = _filled_input(spark, base, 4)
    return present(fill.temporal_fill_linear(a, FILL_COLS, ["date", "grid_id"], "ts", 0.2, "rain"))


def q65_temporal_fill_linear(spark: SparkSession, base: str) -> DataFrame:
    """INT-1 (linear method) on 8 grids, where some series exceed the 20 % gate and stay unfilled."""
    a = _filled_input(spark, base, 8)
    return present(fill.temporal_fill_linear(a, FILL_COLS, ["date", "grid_id"], "ts", 0.2, "rain"))


def q13_mean_field(spark: SparkSession, base: str) -> DataFrame:
    """AGG-4 + SET-2 + PHY-1: air density, then per-time means prepended as grid-less rows."""
    d = quality.sentinel_to_null(_obs_dedup(spark, base, 4).drop("page", "row_ord"), ["slp", "rh"])
    d = d.withColumn("air_density", phy.air_density("t", "slp", "rh"))
    return present(features.with_mean_field(d, "ts", FILL_COLS + ["air_density"]))


def q14_wind_components(spark: SparkSession, base: str) -> DataFrame:
    """PHY-3 + PHY-4: speed/direction → x/y components (originals dropped), then the speed back."""
    d = _obs_dedup(spark, base, 4).select("ts", "grid_id", "speed", "dir")
    w = phy.wind_components(d, [("speed", "dir")])
    return present(w.withColumn("ws", phy.magnitude("speed_x", "speed_y")))


def q15_air_density(spark: SparkSession, base: str) -> DataFrame:
    """PHY-1 on the station view (sentinels already NULL)."""
    d = quality.sentinel_to_null(_obs_dedup(spark, base, 4), ["slp", "rh"])
    return present(d.select("ts", "grid_id", phy.air_density("t", "slp", "rh").alias("air_density")))


REAN_COLS = ["t2m", "d2m", "u10", "v10", "sp", "tp"]


def _reanalysis_merged(spark: SparkSession, base: str) -> DataFrame:
    r = views.reanalysis(spark, base)
    return grid.first_non_null(r, ["ts", "lon", "lat"], "ord", REAN_COLS)


def q16_relative_humidity(spark: SparkSession, base: str) -> DataFrame:
    """PHY-2 on the reanalysis view (Kelvin inputs)."""
    r = views.reanalysis(spark, base)
    return present(r.select("ts", "lon", "lat", phy.relative_humidity("t2m", "d2m").alias("rh")))


def q17_units_log(spark: SparkSession, base: str) -> DataFrame:
    """PHY-2/4 derived first, then PHY-5 unit rules with PHY-6 bounds and PHY-7 log1p (no clip)."""
    r = views.reanalysis(spark, base).drop("ord")
    r = r.withColumns({"rh": phy.relative_humidity("t2m", "d2m"), "ws": phy.magnitude("u10", "v10")})
    r = phy.convert_units(r, phy.REANALYSIS_UNITS)
    r = phy.log1p_columns(r, phy.REANALYSIS_LOG, clip_at_zero=False)
    return present(r)


def q74_unit_rules(spark: SparkSession, base: str) -> DataFrame:
    """PHY-5/6/7: all unit rules of both sources: skin temperature, pressures, geopotential, cloud cover beyond its bounds,
    radiation, boundary layer, precipitation, station pressure; then log1p of the long tails of both, clipped at 0 for stations."""
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    q, price, disc, tax = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    raw = li.select("l_orderkey", "l_linenumber", (q + 250).alias("skt"), (price * 2).alias("sp"), (price * 3).alias("msl"), (price * 10 - 5000).alias("z"),
                    (q * 40).alias("blh"), (disc * 20 - 0.5).alias("lcc"), (tax * 15).alias("tcc"), (disc / 100 - 0.0002).alias("tp"),
                    (q * 36000 - 100000).alias("ssrd"), (q * 20).alias("cape"), (q / 2).alias("i10fg"), (price / 30).alias("slp"),
                    (q - 10).alias("rain01h"), (q / 5).alias("v"))
    r = phy.convert_units(phy.convert_units(raw, phy.REANALYSIS_UNITS), phy.STATION_UNITS)
    r = phy.log1p_columns(phy.log1p_columns(r, phy.REANALYSIS_LOG, clip_at_zero=False), phy.STATION_LOG, clip_at_zero=True)
    return present(r)


def q75_ignored_days(spark: SparkSession, base: str) -> DataFrame:
    """FLT-3, the other side: days below the completeness gate, and the days of data that the report does not know."""
    d = _obs_dedup(spark, base, 4)
    rep = quality.completeness(d, "ts", "grid_id", max_grid_id=3, step_minutes=HOURLY)
    known = rep.filter(F.dayofmonth("date") % 7 != 0)  # a report that misses every seventh day
    return present(quality.completeness_filter(d, known, "ts", 0.95)[1])


def q18_first_non_null(spark: SparkSession, base: str) -> DataFrame:
    """AGG-5: one row per (ts, lon, lat), each column's first non-NULL value in source order."""
    return present(_reanalysis_merged(spark, base))


def q19_grid_ids(spark: SparkSession, base: str) -> DataFrame:
    """AGG-6 + WIN-4 + JN-4: ids ranked by (lat, lon) over distinct coordinates, joined back."""
    c = views.coords(spark, base, "customer")
    return present(grid.attach_grid_ids(c, "lon", "lat"))


def q20_tail_truncate(spark: SparkSession, base: str) -> DataFrame:
    """FLT-5: per day keep the last T×G = 1×16 merged rows in (ts, lon, lat) order."""
    m = _reanalysis_merged(spark, base).select("ts", "lon", "lat", "t2m")
    return present(grid.tail_truncate(m, "ts", ["lon", "lat"], steps=1, grids=16))


def _wrapped_customers(spark: SparkSession, base: str) -> DataFrame:
    c = views.coords(spark, base, "customer")
    return c.select("id", geo.wrap_lon("lon").alias("lon"), geo.bound_lat("lat").alias("lat"))


def q21_wrap_lonlat(spark: SparkSession, base: str) -> DataFrame:
    """GEO-1: longitudes to -180..180, latitudes bounded to ±89.9999."""
    return present(_wrapped_customers(spark, base))


def q22_axis_order(spark: SparkSession, base: str) -> DataFrame:
    """GEO-2: coordinates delivered as (lat, lon) are detected and flipped."""
    c = views.coords(spark, base, "customer").select("id", F.col("lat").alias("a"), F.col("lon").alias("b"))
    return present(geo.axis_order(c, "a", "b").select("id", "lon", "lat"))


def q23_location_batches(spark: SparkSession, base: str) -> DataFrame:
    """GEO-3: consecutive batches of 80 points in id order, ``lat,lon`` joined with ``|``."""
    c = _wrapped_customers(spark, base)
    pos = grid.global_position(c, F.floor(F.col("id") / 4096), ["id"], "pos")
    b = pos.withColumn("batch", F.floor(F.col("pos") / geo.LOCATION_BATCH).cast("bigint"))
    out = b.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", geo.location_text("lon", "lat").alias("s")))),
                                 lambda e: e["s"]), "|").alias("locations"))
    return present(out)


def q24_coords_min_max(spark: SparkSession, base: str) -> DataFrame:
    """GEO-5 (+ AGG-8): per-axis min-max scaling of supplier coordinates."""
    c = views.coords(spark, base, "supplier")
    return present(geo.min_max_scaled(c, ["lon", "lat"]))


def q25_coords_sphere(spark: SparkSession, base: str) -> DataFrame:
    """GEO-6: unit-sphere embedding of supplier coordinates."""
    c = views.coords(spark, base, "supplier").withColumn("xyz", geo.sphere_xyz("lon", "lat"))
    return present(c.select("id", F.col("xyz")[0].alias("sx"), F.col("xyz")[1].alias("sy"),
                            F.col("xyz")[2].alias("sz")))


def q26_elevation_join(spark: SparkSession, base: str) -> DataFrame:
    """GEO-7 + AGG-8: elevation per point joined by id and min-max scaled."""
    c = views.coords(spark, base, "supplier")
    elev = read_table(spark, base, "supplier", ["s_suppkey", "s_acctbal"]).select(
        F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_acctbal").alias("elevation"))
    j = c.join(elev, "id", "left")
    return present(geo.min_max_scaled(j, ["elevation"]))


def q27_grid_generate(spark: SparkSession, base: str) -> DataFrame:
    """GEO-4: a 5-degree grid over the area the customer points span, generated with sequences."""
    c = _wrapped_customers(spark, base)
    step = 5.0
    area = c.agg(F.max("lat").alias("north"), F.min("lon").alias("west"),
                 F.min("lat").alias("south"), F.max("lon").alias("east"))
    n_lat, n_lon = geo.grid_shape(F.col("north"), F.col("west"), F.col("south"), F.col("east"), step, step)
    a = area.select("*", n_lat.alias("n_lat"), n_lon.alias("n_lon"))
    rows = a.select("*", F.explode(F.sequence(F.lit(0), F.col("n_lat") - 1)).alias("i")).repartition("i")
    cells = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n_lon") - 1)).alias("j"))
    return present(cells.select(
        (F.col("i") * F.col("n_lon") + F.col("j")).cast("bigint").alias("grid_id"),
        (F.col("south") + F.col("i") * step).alias("lat"),
        geo.wrap_lon(F.col("west") + F.col("j") * step).alias("lon"), "n_lat", "n_lon"))


def q28_normalise(spark: SparkSession, base: str) -> DataFrame:
    """NRM-1 + AGG-9: per-position z-score of embeddings (fitted on all rows) and within-label z-score."""
    e = read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"])
    z = moments.normalise(moments.with_stats(e, "embedding"), "embedding", "stats", "z")
    g = moments.with_stats(z, "embedding", by=["label"], out="group_stats")
    g = moments.normalise(g, "embedding", "group_stats", "x_z")
    return present(g.select("vec_id", F.posexplode(F.arrays_zip("z", "x_z")).alias("pos", "p"))
                   .select("vec_id", "pos", "p.z", "p.x_z"))


def q70_train_split(spark: SparkSession, base: str) -> DataFrame:
    """NRM-1 on a time-ordered split: statistics of the packed steps of the first 70 % of the days, applied to every day
    per feature, and the inverse, which gives the values back."""
    p = _packed_days(spark, base)
    boundary = moments.train_boundary(read_table(spark, base, "events", ["ts"]).select(F.to_date("ts").alias("d")), "d", 0.7)
    p = moments.with_stats(p.withColumn("train", F.col("date") < boundary), "features", fit=F.col("train"))
    p = moments.normalise(p, "features", "stats", "z", nested=True)
    p = moments.denormalise(p, "z", "stats", "back", nested=True)
    nodes = p.select("date", "step", "train", F.posexplode(F.arrays_zip("z", "back")).alias("node_pos", "v"))
    flat = nodes.select("date", "step", "train", "node_pos", F.posexplode(F.arrays_zip(F.col("v.z").alias("z"), F.col("v.back").alias("back")))
                        .alias("feature", "e"))
    return present(flat.select("date", "step", "train", "node_pos", "feature", "e.z", "e.back"), digits=4)


SAMPLE_FEATURES = ["t", "rh", "speed"]


def _filled_steps(spark: SparkSession, base: str) -> DataFrame:
    a = _filled_input(spark, base, 4)
    f = fill.temporal_fill_linear(a, FILL_COLS, ["date", "grid_id"], "ts", 0.2, "rain")
    return f.withColumn("step", tx.step_of_day("ts", HOURLY).cast("bigint"))


def _first_obs_day(spark: SparkSession, base: str):
    """First day with data, as a scalar subquery read straight off the events scan."""
    return read_table(spark, base, "events", ["ts"]).agg(F.min(F.to_date("ts"))).scalar()


def _series_length(spark: SparkSession, base: str):
    """S = days from the first to the last ship date, as a scalar subquery off the line-item scan."""
    li = read_table(spark, base, "lineitem", ["l_shipdate"])
    return li.agg((F.datediff(F.max(F.to_date("l_shipdate")), F.min(F.to_date("l_shipdate"))) + 1)
                  .cast("bigint")).scalar()


def _packed_days(spark: SparkSession, base: str) -> DataFrame:
    return tensors.pack_steps(_filled_steps(spark, base), ["date", "step", "ts"], "grid_id", SAMPLE_FEATURES)


def q35_pack_day(spark: SparkSession, base: str) -> DataFrame:
    """TNS-2 + DT-8: (time, grid) rows → [G, F] float32 per step, shown unpacked with date parts."""
    p = _packed_days(spark, base).withColumn("parts", tx.datetime_parts("ts"))
    keys = ["date", "step", "parts"]
    flat = tensors.unpack_steps(p, keys, "features", "node_pos", "feature", "value")
    return present(flat.select("date", "step", "node_pos", "feature", "value",
                               *[F.col("parts")[i].alias(n) for i, n in
                                 enumerate(["year", "month", "day", "hour", "minute"])]))


def q29_step_samples_masked(spark: SparkSession, base: str) -> DataFrame:
    """SMP-1 + MSK-1/2: one sample per (day, step), 25 % of nodes masked to 0 in data, target kept."""
    p = _packed_days(spark, base)
    first = _first_obs_day(spark, base)
    p = p.withColumn("sample_id", (F.datediff("date", first) * 24 + F.col("step")).cast("bigint"))
    smp = tensors.step_samples(p, "sample_id", mask_rate=0.25, seed=7)
    a = smp.select("sample_id", F.posexplode(F.arrays_zip("data", "target", "mask", "nodes")).alias("node_pos", "e"))
    b = a.select("sample_id", F.col("e.nodes").alias("grid_id"), F.col("e.mask").alias("masked"),
                 F.posexplode(F.arrays_zip(F.col("e.data").alias("d"), F.col("e.target").alias("t"))).alias("feature", "v"))
    return present(b.select("sample_id", "grid_id", "masked", "feature", F.col("v.d").alias("data"),
                            F.col("v.t").alias("target")))


def q30_sliding_in_day(spark: SparkSession, base: str) -> DataFrame:
    """SMP-2 + SMP-6: windows of 4 input + 2 target steps, stride 2, inside each day."""
    f = _filled_steps(spark, base).select("date", "step", "grid_id", "t")
    w = tensors.sliding_window_rows(f, ["date"], "step", 24, 4, 2, 2)
    return present(w.select("date", "window_start", "k", "part", "grid_id", "t"))


def q31_tumbling_in_day(spark: SparkSession, base: str) -> DataFrame:
    """SMP-3 + SMP-6: non-overlapping 6-step windows inside each day (24 mod 6 = 0)."""
    f = _filled_steps(spark, base).select("date", "step", "grid_id", "t")
    w = tensors.tumbling_window_rows(f, "step", 6, steps_per_group=24)
    w = w.withColumn("part", F.when(F.col("k") < 4, F.lit("input")).otherwise(F.lit("target")))
    return present(w.select("date", "window_id", "k", "part", "grid_id", "t"))


def q32_sliding_series(spark: SparkSession, base: str) -> DataFrame:
    """SMP-4 + SMP-6: S - W + 1 stride-1 windows (W = 4, the last step is the target) over the whole daily lineitem series."""
    s = views.daily_series(spark, base)
    w = tensors.series_sliding_rows(s, "step", 4, _series_length(spark, base))
    part = F.when(F.col("k") < 3, F.lit("input")).otherwise(F.lit("target"))
    return present(w.select("window_start", "k", part.alias("part"), "node", "channel", "value"))


def q33_tumbling_series(spark: SparkSession, base: str) -> DataFrame:
    """SMP-5 + SMP-6: S div W windows (W = 7, remainder dropped) as arrays, 5 steps of input and 2 to predict, shown by step."""
    s = views.daily_series(spark, base)
    w = tensors.tumbling_window_rows(s, "step", 7, drop_remainder_of=_series_length(spark, base))
    keys = ["window_id", "node", "channel"]
    entry = F.struct("k", "value")  # a day without the node is no step of its window
    a = tensors.windows_to_arrays(w, keys, "k", entry, 5)
    both = F.concat(F.transform("data", lambda e: F.struct(F.lit("input").alias("part"), e.alias("e"))),
                    F.transform("target", lambda e: F.struct(F.lit("target").alias("part"), e.alias("e"))))
    flat = a.select(*keys, F.explode(both).alias("v"))
    return present(flat.select("window_id", F.col("v.e.k").alias("k"), F.col("v.part").alias("part"), "node", "channel", F.col("v.e.value").alias("value")))


def q34_wide_to_long(spark: SparkSession, base: str) -> DataFrame:
    """TNS-1 + SRC-9: a wide daily table (one column per measure) to (day, channel, value)."""
    li = read_table(spark, base, "lineitem", ["l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    wide = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("price"),
        F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"))
    return present(tensors.wide_to_long(wide, ["date"], ["qty", "price", "discount", "tax"], "channel"))


def q36_regular_timestamps(spark: SparkSession, base: str) -> DataFrame:
    """DT-5: event i at ``first minute + 5·i minutes`` (true calendar arithmetic)."""
    e = read_table(spark, base, "events", ["event_id", "ts"])
    start = e.agg(F.min(tx.trunc_minute("ts"))).scalar()
    return present(e.select("event_id", tx.regular_timestamp(start, "event_id", 5).alias("regular_ts")))


def q37_slot_timestamp(spark: SparkSession, base: str) -> DataFrame:
    """DT-6: ``yyyyMMddSS`` half-hour slot codes (slot from the order key) to timestamps."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate"])
    d = F.col("o_orderdate")
    code = F.format_string("%04d%02d%02d%02d", F.year(d), F.month(d), F.dayofmonth(d),
                           F.pmod("o_orderkey", F.lit(48)) + 1)
    c = o.select("o_orderkey", code.alias("slot_code"))
    return present(c.withColumn("ts", tx.slot_timestamp("slot_code")))


def q38_parse_mixed(spark: SparkSession, base: str) -> DataFrame:
    """DT-7: order times written in five styles (one unparsable) parsed back; bad text → NULL."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate"])
    t = (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.pmod("o_orderkey", F.lit(24)).cast("int"),
                                                    F.pmod("o_orderkey", F.lit(60)).cast("int")))
    style = F.pmod("o_orderkey", F.lit(5))
    y, mo, dd, h, mi, se = F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t)
    text = (F.when(style == 0, F.format_string("%04d-%02d-%02d %02d:%02d:%02d", y, mo, dd, h, mi, se))
            .when(style == 1, F.format_string("%04d/%02d/%02d %02d:%02d", y, mo, dd, h, mi))
            .when(style == 2, F.format_string("%04d-%02d-%02d", y, mo, dd))
            .when(style == 3, F.format_string("%04d%02d%02d", y, mo, dd))
            .otherwise(F.lit("n/a")))
    c = o.select("o_orderkey", text.alias("text"))
    return present(c.withColumn("parsed", tx.parse_mixed("text")))


def q39_series_shape(spark: SparkSession, base: str) -> DataFrame:
    """VAL-2/VAL-3 (+ Q21 regularity): the daily series against five descriptors: one that fits, one with half its step
    (irregular), one with another length, one with the right number of times but some of them off their slot, and one
    whose data set is absent."""
    from gridloom.sources import catalog as cat

    names = F.explode(F.array(*[F.lit(n) for n in ("lineitem_daily", "lineitem_half_daily", "lineitem_short", "lineitem_off_slot")]))
    s = views.daily_series(spark, base).withColumn("dataset", names)
    noon = (F.col("dataset") == "lineitem_off_slot") & (F.col("step") % 5 == 1)
    s = s.withColumn("ts", F.when(noon, F.col("ts") + F.expr("INTERVAL 12 HOURS")).otherwise(F.col("ts")))
    return present(cat.validate(s, [cat.Descriptor("lineitem_daily", "node_frame", 1440, 8, 2),
                                    cat.Descriptor("lineitem_half_daily", "node_frame", 720, 8, 2),
                                    cat.Descriptor("lineitem_short", "node_frame", 1440, 8, 2, 5),
                                    cat.Descriptor("lineitem_off_slot", "node_frame", 1440, 8, 2),
                                    cat.Descriptor("lineitem_absent", "wide_channels", 60, 3, 1, 24)]))


def q40_spatial_fill_local(spark: SparkSession, base: str) -> DataFrame:
    """INT-6: missing cells of each hour from known cells within 0.08 degrees (weights 1/d²)."""
    d = _obs_dedup(spark, base, 8).select("ts", "grid_id", "t", "speed")
    g = scaffold.center_coords(views.grids(spark, base, 8))
    a = scaffold.align(d, None, HOURLY, max_grid_id=7).select("ts", "grid_id", "t", "speed")
    pairs = spatial.neighbour_pairs(g, 0.08, "grid_id", "lon_center", "lat_center")
    return present(spatial.idw_fill(a, pairs, ["t", "speed"], "ts", "grid_id", 2.0, 0.2))


def _cells(spark: SparkSession, base: str) -> DataFrame:
    """Flow-field cell table (A8) with the declared schema, built from embeddings."""
    e = read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"])
    sch = FLOW_CELLS.struct_type()
    numeric = [f.name for f in sch.fields if f.name not in ("cell_id", "cell_type", "cell_type_name", "nverts")]
    cols = {"cell_id": F.col("vec_id").cast("bigint"), "cell_type": F.col("label").cast("bigint"),
            "cell_type_name": F.concat(F.lit("type"), F.col("label").cast("string")),
            "nverts": F.lit(3).cast("bigint")}
    cols.update({c: F.col("embedding")[i].cast("double") for i, c in enumerate(numeric)})
    return e.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in sch.fields])


def q49_feature_groups(spark: SparkSession, base: str) -> DataFrame:
    """SRC-16 + PRJ-7: validate the declared groups (2 + 6 + 8), select coordinate/physical/gradient."""
    FLOW_CELLS.validate()
    c = _cells(spark, base)
    return present(c.select("cell_id", *FLOW_CELLS.features))


def q50_date_range_day_filter(spark: SparkSession, base: str) -> DataFrame:
    """AGG-1 + FLT-1: overall page time range, and the rows of the second day of data."""
    o = views.obs(spark, base, 4)
    spans = o.groupBy("page").agg(F.min("ts").alias("span_start"), F.max("ts").alias("span_end"))
    rng = quality.date_range(spans, "span_start", "span_end")
    day = F.date_add(F.to_date(rng.select("min_time").scalar()), 1)
    rows = quality.day_filter(o, "ts", day).select("ts", "grid_id", "row_ord")
    return present(rows.withColumns({"min_time": rng.select("min_time").scalar(),
                                     "max_time": rng.select("max_time").scalar()}))


def _density_rows(spark: SparkSession, base: str) -> DataFrame:
    d = quality.sentinel_to_null(_obs_dedup(spark, base, 4).drop("page", "row_ord"), ["slp", "rh"])
    return d.withColumn("air_density", phy.air_density("t", "slp", "rh"))


def q51_drop_mean_field(spark: SparkSession, base: str) -> DataFrame:
    """FLT-4 after AGG-4 + SET-2: removing the mean-field rows gives the grid rows back."""
    m = features.with_mean_field(_density_rows(spark, base), "ts", FILL_COLS + ["air_density"])
    return present(features.drop_mean_field(m))


def q52_null_report(spark: SparkSession, base: str) -> DataFrame:
    """FLT-6 + AGG-10: per day, any NULL on the scaffold and each column's NULL share."""
    return present(quality.null_report(_filled_input(spark, base, 8), "ts", FILL_COLS))


def q53_file_status(spark: SparkSession, base: str) -> DataFrame:
    """AGG-13 + VAL-1 + VAL-2: per day rows vs T×G and distinct times vs T, with a reason."""
    return present(quality.day_status(_obs_dedup(spark, base, 8), "ts", 24, 8))


def q54_step_index(spark: SparkSession, base: str) -> DataFrame:
    """WIN-5 + AGG-7: step = rank of the time among the day's distinct times (window over times only)."""
    d = _obs_dedup(spark, base, 4).select("ts", "grid_id")
    steps = quality.step_index(d, "ts")
    return present(d.join(steps, "ts").select("ts", "grid_id", "step", "n_times"))


def q55_conform_schema(spark: SparkSession, base: str) -> DataFrame:
    """PRJ-1/2/3/5/6: raw-like reanalysis names → unified names, bookkeeping dropped, absent feature 0."""
    r = views.reanalysis(spark, base).drop("ord")
    raw = r.select(F.col("ts").alias("valid_time"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
                   *REAN_COLS, F.lit(0).alias("number"), F.lit("0001").alias("expver"))
    c = features.unify_names(features.drop_columns(raw))
    feats = ["t2m", "d2m", "u10", "v10", "sp", "msl", "tp"]
    c = features.add_missing_zero(c, feats)
    return present(features.keep_columns(features.order_columns(c, ["ts", "lon", "lat", *feats]),
                                         ["ts", "lon", "lat", *feats]))


def q56_sample_context(spark: SparkSession, base: str) -> DataFrame:
    """JN-10 + JN-11 + SRC-15: each step sample with its timestamp and the coordinates of its nodes."""
    p = _packed_days(spark, base).select("date", "step", "nodes")
    first = _first_obs_day(spark, base)
    p = p.withColumn("sample_id", (F.datediff("date", first) * 24 + F.col("step")).cast("bigint"))
    time_index = _filled_steps(spark, base).select("date", "step", "ts").distinct()
    coords_tbl = scaffold.center_coords(views.grids(spark, base, 4)) \
        .select("grid_id", "lon_center", "lat_center")
    s = p.join(time_index, ["date", "step"], "left")
    nodes = s.select("sample_id", "step", "ts", F.explode("nodes").alias("grid_id"))
    return present(joins.dimension_join(nodes, coords_tbl, "grid_id", "left"))


def q57_key_lookup(spark: SparkSession, base: str) -> DataFrame:
    """JN-9: completeness ratio looked up for every date of the station calendar (end + 1 day included)."""
    d = _obs_dedup(spark, base, 4)
    rep = quality.completeness(d, "ts", "grid_id", max_grid_id=3, step_minutes=HOURLY)
    bounds = rep.agg(F.min("date").alias("s"), F.date_add(F.max("date"), 1).alias("e"))
    lookups = scaffold.date_range_days(bounds, "s", "e")
    return present(joins.key_lookup(rep, lookups, "date", "completeness_ratio", out="completeness_ratio"))


def q58_first_step_coords(spark: SparkSession, base: str) -> DataFrame:
    """LIM-1 + SNK-7: grid coordinates taken at the first step of each day, checked to be one per id."""
    d = _obs_dedup(spark, base, 8).drop("page", "row_ord")
    a = scaffold.align(d, views.grids(spark, base, 8), HOURLY, max_grid_id=7)
    first = a.filter(tx.step_of_day("ts", HOURLY) == 0)
    return present(first.groupBy("grid_id").agg(
        F.min("lon_center").alias("lon"), F.min("lat_center").alias("lat"),
        F.count_distinct("lon_center", "lat_center").alias("n_variants"),
        F.count(F.lit(1)).alias("n_days")))


def q59_union_dedup(spark: SparkSession, base: str) -> DataFrame:
    """SET-1 + WIN-1: two overlapping time slices of the pages, unioned and deduplicated."""
    o = views.with_page_span(views.obs(spark, base, 4))
    secs = tx.epoch_seconds("ts")
    b = o.agg(F.min(secs).alias("lo"), F.max(secs).alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    a = o.filter(secs < lo + (hi - lo) * 0.6)
    c = o.filter(secs >= lo + (hi - lo) * 0.4)
    u = dedup.union_slices([a, c])
    d = dedup.dedup_keep_first(u, ["ts", "grid_id"], ["span_start", "page", "row_ord"]).drop("span_start")
    return present(d)


def q60_set_difference(spark: SparkSession, base: str) -> DataFrame:
    """SET-3: scaffold cells minus present cells (``exceptAll``)."""
    d = _obs_dedup(spark, base, 8).select("ts", "grid_id")
    sc = scaffold.scaffold(scaffold.data_days(d), HOURLY, 7).select("ts", "grid_id")
    return present(sc.exceptAll(d))


def q64_time_labels(spark: SparkSession, base: str) -> DataFrame:
    """DT-2 + DT-9 + STR-2: the day's scheduled times with ``HH:mm`` labels and compact names."""
    days = scaffold.data_days(views.obs(spark, base, 4))
    t = days.select("date", F.explode(tx.day_points("date", HOURLY)).alias("ts"))
    return present(t.withColumns({"label": tx.time_label("ts"), "compact": tx.compact_time("ts")}))


def _located_input(spark: SparkSession, base: str, n_grids: int = 8) -> DataFrame:
    d = _obs_dedup(spark, base, n_grids).drop("page", "row_ord")
    d = quality.sentinel_to_null(d, ["slp", "rh"])
    return scaffold.align(d, views.grids(spark, base, n_grids), HOURLY, max_grid_id=n_grids - 1)


#: places shown of solved values: the systems' rounding errors stay far below
SOLVED_DIGITS = 4


def q41_cubic_fill(spark: SparkSession, base: str) -> DataFrame:
    """INT-2: not-a-knot cubic through the known steps of each (day, grid) series; edges carried."""
    a = _filled_input(spark, base, 8)
    methods = {"t": Method("cubic"), "slp": Method("cubic"), "speed": Method("cubic")}
    return present(interp.temporal_pass(a, methods, ["date", "grid_id"], "ts", 0.2), SOLVED_DIGITS)


def q42_spline_fill(spark: SparkSession, base: str) -> DataFrame:
    """INT-3: interpolating splines of order 2 (humidity) and 3 (temperature) per (day, grid) series."""
    a = _filled_input(spark, base, 8)
    methods = {"rh": Method("spline", 2), "t": Method("spline", 3)}
    return present(interp.temporal_pass(a, methods, ["date", "grid_id"], "ts", 0.2), SOLVED_DIGITS)


def q43_spatial_fill(spark: SparkSession, base: str) -> DataFrame:
    """INT-4: per hour, multiquadric radial basis over z-scored grid centres fills missing cells."""
    a = _located_input(spark, base, 8)
    return present(interp.spatial_pass(a, ["t", "rh", "slp", "speed"], "ts", "lon_center", "lat_center", 0.2), SOLVED_DIGITS)


def q71_spatial_fill_tiled(spark: SparkSession, base: str) -> DataFrame:
    """INT-4 past one task: the kernel of all nodes inverted in tiles of 3 x 3 nodes, each hour filled from rows of the
    inverse; the result is that of q43."""
    a = _located_input(spark, base, 8)
    inverse = kernel.kernel_inverse(scaffold.center_coords(views.grids(spark, base, 8)), block=3)
    return present(kernel.spatial_pass_tiled(a, ["t", "rh", "slp", "speed"], inverse, "ts", 0.2), SOLVED_DIGITS)


# Per-column methods of the station fill (wind components are filled linearly).
STATION_METHODS = {"t": Method("cubic"), "slp": Method("cubic"), "rh": Method("spline", 2),
                   "rain": Method("linear"), "speed_x": Method("linear"), "speed_y": Method("linear")}


def q44_st_fill(spark: SparkSession, base: str) -> DataFrame:
    """INT-5 (+ PHY-3, PHY-1, AGG-4): wind to components, space then time passes twice, days that
    remain incomplete dropped, air density and the mean field added."""
    a = phy.wind_components(_located_input(spark, base, 8), [("speed", "dir")])
    filled, _status = interp.st_fill(a, STATION_METHODS, "date", "grid_id", "ts", "lon_center", "lat_center")
    filled = filled.withColumn("air_density", phy.air_density("t", "slp", "rh"))
    out = features.with_mean_field(filled.drop("observed"), "ts", list(STATION_METHODS) + ["air_density"])
    return present(out)  # means of eight given values end in multiples of 0.000125: fewer places would round ties


QUERIES = {
    "q01_completeness_daily": q01_completeness_daily,
    "q02_dedup_keep_first": q02_dedup_keep_first,
    "q03_missing_times": q03_missing_times,
    "q04_gap_runs": q04_gap_runs,
    "q05_scaffold_join": q05_scaffold_join,
    "q06_completeness_filter": q06_completeness_filter,
    "q07_missing_pages": q07_missing_pages,
    "q08_missing_dates": q08_missing_dates,
    "q09_chunk_plan": q09_chunk_plan,
    "q10_span_overlap": q10_span_overlap,
    "q11_sentinel_null": q11_sentinel_null,
    "q12_linear_fill": q12_linear_fill,
    "q13_mean_field": q13_mean_field,
    "q14_wind_components": q14_wind_components,
    "q15_air_density": q15_air_density,
    "q65_temporal_fill_linear": q65_temporal_fill_linear,
    "q16_relative_humidity": q16_relative_humidity,
    "q17_units_log": q17_units_log,
    "q18_first_non_null": q18_first_non_null,
    "q19_grid_ids": q19_grid_ids,
    "q20_tail_truncate": q20_tail_truncate,
    "q21_wrap_lonlat": q21_wrap_lonlat,
    "q22_axis_order": q22_axis_order,
    "q23_location_batches": q23_location_batches,
    "q24_coords_min_max": q24_coords_min_max,
    "q25_coords_sphere": q25_coords_sphere,
    "q26_elevation_join": q26_elevation_join,
    "q27_grid_generate": q27_grid_generate,
    "q28_normalise": q28_normalise,
    "q29_step_samples_masked": q29_step_samples_masked,
    "q30_sliding_in_day": q30_sliding_in_day,
    "q31_tumbling_in_day": q31_tumbling_in_day,
    "q32_sliding_series": q32_sliding_series,
    "q33_tumbling_series": q33_tumbling_series,
    "q34_wide_to_long": q34_wide_to_long,
    "q35_pack_day": q35_pack_day,
    "q36_regular_timestamps": q36_regular_timestamps,
    "q37_slot_timestamp": q37_slot_timestamp,
    "q38_parse_mixed": q38_parse_mixed,
    "q39_series_shape": q39_series_shape,
    "q40_spatial_fill_local": q40_spatial_fill_local,
    "q41_cubic_fill": q41_cubic_fill,
    "q42_spline_fill": q42_spline_fill,
    "q43_spatial_fill": q43_spatial_fill,
    "q44_st_fill": q44_st_fill,
    "q49_feature_groups": q49_feature_groups,
    "q50_date_range_day_filter": q50_date_range_day_filter,
    "q51_drop_mean_field": q51_drop_mean_field,
    "q52_null_report": q52_null_report,
    "q53_file_status": q53_file_status,
    "q54_step_index": q54_step_index,
    "q55_conform_schema": q55_conform_schema,
    "q56_sample_context": q56_sample_context,
    "q57_key_lookup": q57_key_lookup,
    "q58_first_step_coords": q58_first_step_coords,
    "q59_union_dedup": q59_union_dedup,
    "q60_set_difference": q60_set_difference,
    "q64_time_labels": q64_time_labels,
    "q70_train_split": q70_train_split,
    "q71_spatial_fill_tiled": q71_spatial_fill_tiled,
    "q74_unit_rules": q74_unit_rules,
    "q75_ignored_days": q75_ignored_days,
}


def _io_queries() -> dict:
    from gridloom.plans.io_queries import IO_QUERIES
    return IO_QUERIES


QUERIES.update(_io_queries())
