"""Queries that go through files or streams: JSON pages, page CSVs, tensor files,
dataset catalog, merged cubes and streaming ingest.

Everything written lands in a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``), never in a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import timeaxis as tx
from gridloom.operators import dedup, grid, joins, quality, scaffold
from gridloom.operators.samples import Windowing
from gridloom.plans import views
from gridloom.plans.present import map_text, present
from gridloom.session import scratch_path
from gridloom.sources import catalog, dataset, pages, tensorfiles
from gridloom.sources.tables import read_table
from gridloom.streaming import ingest, upserts

HOURLY = 60

OBS_ROW = T.StructType([
    T.StructField("ts", T.StringType()), T.StructField("grid_id", T.LongType()),
    T.StructField("t", T.DoubleType()), T.StructField("rh", T.DoubleType()),
    T.StructField("slp", T.DoubleType()), T.StructField("speed", T.DoubleType()),
    T.StructField("dir", T.DoubleType()), T.StructField("rain", T.DoubleType()),
    T.StructField("row_ord", T.LongType())])


def q45_json_pages(spark: SparkSession, base: str) -> DataFrame:
    """SRC-3: pages rebuilt as ``{"data": [rows]}`` documents (one per page) and parsed back to rows."""
    o = views.obs(spark, base, 4)
    row = F.struct(tx.ntz_text("ts").alias("ts"),
                   *[F.col(f.name) for f in OBS_ROW.fields if f.name != "ts"])
    docs = o.groupBy("page").agg(F.to_json(F.struct(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("row_ord").alias("o"), row.alias("r")))),
        lambda e: e["r"]).alias("data"))).alias("value"))
    rows = pages.parse_json_pages(docs, OBS_ROW)
    return present(rows.withColumn("ts", tx.parse_exact("ts")))


STREAM_FILES = 4


def _event_stream(spark: SparkSession, base: str) -> DataFrame:
    """Events as a stream of files, one file a trigger (the stand-in for pages that arrive one after another)."""
    events = read_table(spark, base, "events", views.EVENT_COLS)
    folder = scratch_path(spark, "stream-in")
    events.repartition(STREAM_FILES, "event_id").write.parquet(folder)
    return ingest.file_stream(spark, folder, events.schema, max_files_per_trigger=1)


#: longer than the events table, so that no row of it is late whatever the order of its files
WHOLE_TABLE = "366 days"


def q46_stream_dedup(spark: SparkSession, base: str) -> DataFrame:
    """STM-1: events streamed in several triggers, bucketed like ``obs``; the first row of every (hour, grid) by
    (page span start, page, row) is kept up to date in state, so the latest versions equal the batch keep-first."""
    stream = views.obs_from_events(_event_stream(spark, base), 4)
    spans = views.obs(spark, base, 4).groupBy("page").agg(F.min("ts").alias("span_start"))  # a page's name carries it
    led = ingest.keep_first_stream(stream.join(spans, "page"), "ts", ["grid_id"], ["span_start", "page", "row_ord"], WHOLE_TABLE)
    out, ck = scratch_path(spark, "stream-dedup"), scratch_path(spark, "stream-dedup-ckpt")
    upserts.run_updates(led, out, ck, ["late"])
    return present(upserts.latest(spark, out, ["ts", "grid_id"], "late = 0").drop("span_start", "late"))


def _late_stream(spark: SparkSession, base: str) -> DataFrame:
    """Two runs over one checkpoint: the newer half of the events, then the older half, all of it past the watermark."""
    o = views.obs(spark, base, 4)
    secs = tx.epoch_seconds("ts")
    bounds = o.agg(F.min(secs).alias("lo"), F.max(secs).alias("hi"))
    middle = (bounds.select("lo").scalar() + bounds.select("hi").scalar()) / 2
    folder, out, ck = (scratch_path(spark, n) for n in ("late-in", "late-out", "late-ckpt"))
    for half in (secs >= middle, secs < middle):
        o.filter(half).write.mode("append").parquet(folder)
        stream = ingest.file_stream(spark, folder, o.schema)
        led = ingest.keep_first_stream(stream, "ts", ["grid_id"], ["page", "row_ord"], "1 hour")
        upserts.run_updates(led, out, ck, ["late"])
    return spark.read.parquet(out)


def q67_stream_late(spark: SparkSession, base: str) -> DataFrame:
    """STM-1 side output: rows that arrive after the watermark has passed their time, counted per day and grid."""
    late = _late_stream(spark, base).filter("late = 1")
    return present(late.groupBy(F.to_date("ts").alias("date"), "grid_id").agg(F.count(F.lit(1)).alias("late_rows")))


def _streamed_cells(spark: SparkSession, base: str) -> str:
    stream = views.obs_from_events(_event_stream(spark, base), 4)
    out, ck = scratch_path(spark, "stream-cells"), scratch_path(spark, "stream-cells-ckpt")
    upserts.run_updates(ingest.step_cells(stream, "ts", "grid_id", 3, HOURLY, WHOLE_TABLE), out, ck)
    return out


def q47_stream_completeness(spark: SparkSession, base: str) -> DataFrame:
    """STM-2: per (day, hour) the rows that arrived and the distinct cells, kept up to date over several triggers;
    open days are shown as well as closed ones."""
    counts = ingest.step_counts(spark, _streamed_cells(spark, base))
    return present(counts.select("date", "time_point", "arrived", F.col("grids_present").alias("cells")))


def q66_stream_report(spark: SparkSession, base: str) -> DataFrame:
    """STM-2 + AGG-3: the daily completeness report merged from the streamed counts, equal to the batch report."""
    rep = ingest.day_report(spark, _streamed_cells(spark, base), 3, HOURLY)
    return present(rep.withColumns({"missing_time_points": F.array_join("missing_time_points", ","),
                                    "incomplete_time_points": map_text(F.col("incomplete_time_points"))}))


SAMPLE_FEATURES = ["t", "rh", "speed"]


TENSOR_SHAPE = (24, 4, 3)


def _tensor_folder(spark: SparkSession, base: str) -> str:
    """The filled station days as a folder of day tensors with metadata, time index, coordinates and elevations."""
    from gridloom.plans.queries import _filled_steps

    f = _filled_steps(spark, base)
    folder = scratch_path(spark, "tensors")
    status = tensorfiles.write_tensor_days(f, folder, 24, 4, SAMPLE_FEATURES)
    status.write.mode("overwrite").parquet(f"{folder}/_status")
    coords = scaffold.center_coords(views.grids(spark, base, 4)).select(
        "grid_id", F.col("lon_center").cast("float").alias("lon"), F.col("lat_center").cast("float").alias("lat"))
    meta = {"num_features": 3, "num_grids": 4, "time_steps_per_day": 24, "feature_names": SAMPLE_FEATURES,
            "coord_names": ["lon", "lat"], "dtype": "float32", "log_transformed_features": [],
            "units_note": "t degC, rh %, speed m/s"}
    times = scaffold.data_days(views.obs(spark, base, 4)).select("date", F.explode(tx.day_points("date", HOURLY)).alias("ts"))
    tensorfiles.write_sidecars(spark, folder, times, coords, meta, elevation=views.elevations(spark, base, 4))
    return folder


def q48_tensor_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """SNK-4..7 + SRC-13/14/15 + VAL-5: day tensors written as float32 files with sidecars and read back; the feature
    names come from the metadata file."""
    folder = _tensor_folder(spark, base)
    names = tensorfiles.read_metadata(spark, f"{folder}/metadata")["feature_names"]
    long, _report = tensorfiles.read_tensor_days(spark, folder, *TENSOR_SHAPE)
    times = tensorfiles.read_time_index(spark, f"{folder}/time_index")
    side = spark.read.parquet(f"{folder}/coords").withColumnRenamed("grid_id", "node")
    out = joins.dimension_join(long.join(times, ["date", "step"], "left"), side, "node", "left")
    named = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("feature") + 1).cast("int"))
    return present(out.select("date", "step", F.col("node").alias("node_pos"), "feature", named.alias("feature_name"), "value",
                              "ts", "lon", "lat"))


def q68_prediction_samples(spark: SparkSession, base: str) -> DataFrame:
    """SMP-2 + SMP-6 + JN-10/11 + SRC-15: all samples of the tensor folder by sample id, 4 steps in and 2 to predict every
    2 steps, each with its times and the coordinates and elevations of its nodes."""
    data = dataset.TensorSamples(spark, _tensor_folder(spark, base), *TENSOR_SHAPE, Windowing(4, 2, 2))
    s = data.samples()
    steps = s.select("sample_id", "date", "start", "datetime", F.posexplode(F.concat("data", "target")).alias("k", "nodes"))
    nodes = steps.select("sample_id", "date", "start", "k", F.col("datetime")[F.col("k")].alias("ts"), F.posexplode("nodes").alias("node", "v"))
    part = F.when(F.col("k") < 4, F.lit("input")).otherwise(F.lit("target"))
    flat = nodes.select("sample_id", "date", "start", "k", part.alias("part"), "ts", F.col("node").cast("long").alias("node"),
                        F.posexplode("v").alias("feature", "value"))
    return present(joins.dimension_join(flat, data.coordinates().drop("grid_id"), "node", "left"))


def q69_masked_samples(spark: SparkSession, base: str) -> DataFrame:
    """SMP-1 + MSK-1/2 + JN-10/11: one complete sample per (day, step): masked data, true target, mask, time, coordinates
    and elevations."""
    data = dataset.TensorSamples(spark, _tensor_folder(spark, base), *TENSOR_SHAPE, Windowing(1))
    s = data.samples(mask_rate=0.25, seed=7)
    nodes = s.select("sample_id", "date", F.col("start").alias("step"), F.col("datetime")[0].alias("ts"),
                     F.posexplode(F.arrays_zip(F.col("data")[0].alias("d"), F.col("target")[0].alias("t"), "mask")).alias("node", "e"))
    flat = nodes.select("sample_id", "date", "step", "ts", F.col("node").cast("long").alias("node"), F.col("e.mask").alias("masked"),
                        F.posexplode(F.arrays_zip(F.col("e.d").alias("d"), F.col("e.t").alias("t"))).alias("feature", "v"))
    flat = flat.select("sample_id", "date", "step", "ts", "node", "masked", "feature", F.col("v.d").alias("data"), F.col("v.t").alias("target"))
    return present(joins.dimension_join(flat, data.coordinates().drop("grid_id"), "node", "left"))


PAGE_COLS = ["DDATETIME", "GRIDID", "T", "MAXTOFDAY", "SLP", "RHSFC", "V", "WSPD", "WDIR", "WD3SMAXDF",
             "WD3SMAXDD", "RAIN01H", "RAIN02H", "RAIN03H", "RAIN06H", "RAIN24H"]


def q61_page_file_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """SRC-1/2/4/5/6 + SNK-1/2/3/9 + SRT-2 + DT-10: pages written as named CSVs, read back once,
    deduplicated, written per day, and the completeness report written and read back."""
    root = scratch_path(spark, "pages")
    o = views.obs(spark, base, 4)
    rows = o.select(tx.ntz_text("ts").alias("DDATETIME"), F.col("grid_id").alias("GRIDID"),
                    F.col("t").alias("T"), F.lit(None).cast("double").alias("MAXTOFDAY"), F.col("slp").alias("SLP"),
                    F.col("rh").alias("RHSFC"), F.lit(None).cast("double").alias("V"), F.col("speed").alias("WSPD"),
                    F.col("dir").alias("WDIR"), F.lit(None).cast("double").alias("WD3SMAXDF"),
                    F.lit(None).cast("double").alias("WD3SMAXDD"), F.col("rain").alias("RAIN01H"),
                    *[F.lit(None).cast("double").alias(c) for c in ("RAIN02H", "RAIN03H", "RAIN06H", "RAIN24H")],
                    "page", "row_ord")
    written = pages.write_pages(rows, f"{root}/raw", "page", "row_ord", PAGE_COLS)
    written.write.mode("overwrite").parquet(f"{root}/_written")
    _write_grid_info(views.grid_dim(o), f"{root}/grid_info")  # with its original headers
    grid_info = pages.read_grid_info(spark, f"{root}/grid_info")

    listed = pages.list_pages(spark, f"{root}/raw")
    raw = pages.read_pages(spark, f"{root}/raw")
    d = dedup.dedup_keep_first(raw, ["ts", "GRIDID"], ["span_start", "page", "row_ord"])
    keep = ["ts", "GRIDID", "T", "SLP", "RHSFC", "WSPD", "WDIR", "RAIN01H"]
    pages.write_daily(d, f"{root}/daily", "ts", order=keep)
    daily = pages.read_daily(spark, f"{root}/daily", keep)
    rep = quality.completeness(daily, "ts", "GRIDID", max_grid_id=3, step_minutes=HOURLY)
    pages.write_completeness(rep, f"{root}/stats")
    stats = pages.read_completeness(spark, f"{root}/stats")
    return present(stats.withColumns({
        "n_grids": grid_info.agg(F.count(F.lit(1))).scalar(),
        "n_files": listed.agg(F.count(F.lit(1))).scalar()}))


def _catalog_series(spark: SparkSession, base: str) -> tuple[str, DataFrame]:
    """(folder of the written series, its write check) of four data sets loaded through the catalog."""
    folder = scratch_path(spark, "npy")

    def node_frame(sp: SparkSession, desc: catalog.Descriptor) -> DataFrame:
        li = read_table(sp, base, "lineitem", ["l_shipdate", "l_suppkey", "l_quantity"])
        wide = li.withColumn("node", (F.col("l_suppkey") % desc.nodes).cast("int")) \
                 .groupBy(F.to_date("l_shipdate").cast("timestamp_ntz").alias("ts")) \
                 .pivot("node", list(range(desc.nodes))).agg(F.sum("l_quantity"))
        return catalog.read_wide(wide, desc.name, "ts", [str(i) for i in range(desc.nodes)], "node")

    def wide_channels(sp: SparkSession, desc: catalog.Descriptor) -> DataFrame:
        li = read_table(sp, base, "lineitem", ["l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
        wide = li.groupBy(F.to_date("l_shipdate").cast("timestamp_ntz").alias("ts")).agg(
            F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("price"),
            F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"))
        return catalog.read_wide(wide, desc.name, "ts", ["qty", "price", "discount", "tax"], "channel")

    def grid_frames(sp: SparkSession, desc: catalog.Descriptor) -> DataFrame:
        e = read_table(sp, base, "embeddings", ["vec_id", "embedding"])
        frames = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda c: F.transform(
            F.sequence(F.lit(0), F.lit(3)), lambda r: F.slice("embedding", c * 32 + r * 8 + 1, 8)))
        return catalog.read_grid_frames(e.select("vec_id", frames.alias("frames")), desc.name, "vec_id", "frames")

    def node_array(sp: SparkSession, desc: catalog.Descriptor) -> DataFrame:
        s = views.daily_series(sp, base)
        status = catalog.write_npy_chunks(s.withColumn("chunk", F.floor(F.col("step") / 32)), folder, "chunk",
                                          "step", "node", "channel", "value", desc.nodes, desc.channels)
        status.write.mode("overwrite").parquet(f"{folder}/_status")
        start = read_table(sp, base, "lineitem", ["l_shipdate"]).agg(
            F.min(F.to_date("l_shipdate")).cast("timestamp_ntz")).scalar()
        return catalog.read_npy_chunks(sp, folder, desc.name, start, desc.step_minutes)

    readers = {"node_frame": node_frame, "wide_channels": wide_channels, "grid_frames": grid_frames,
               "node_array": node_array}
    descs = [catalog.Descriptor("lineitem_nodes", "node_frame", 1440, 8, 1),
             catalog.Descriptor("lineitem_channels", "wide_channels", 1440, 1, 4),
             catalog.Descriptor("embedding_frames", "grid_frames", 30, 32, 2),
             catalog.Descriptor("lineitem_array", "node_array", 1440, 8, 2)]
    longs = [catalog.load(spark, d, readers) for d in descs]
    return f"{folder}/series", catalog.write_series(dedup.union_slices(longs), f"{folder}/series")


def q62_catalog_dispatch(spark: SparkSession, base: str) -> DataFrame:
    """SRC-17 + SRC-9/10/11/12: four data sets loaded through the catalog into one long table."""
    folder, _check = _catalog_series(spark, base)
    return present(spark.read.parquet(folder).select(*catalog.LONG_COLS))


def q76_series_check(spark: SparkSession, base: str) -> DataFrame:
    """SNK-8 + VAL-5: the written series against what is read back, per data set: rows on both sides and equal content."""
    return present(_catalog_series(spark, base)[1].select("dataset", "n", "n_back", "equal"))


def q77_grid_info(spark: SparkSession, base: str) -> DataFrame:
    """SRC-5: the grid dimension file with its original headers, read back by name with its bounds."""
    folder = f"{scratch_path(spark, 'grid')}/grid_info"
    _write_grid_info(views.grids(spark, base, 8), folder)
    return present(pages.read_grid_info(spark, folder))


def q78_daily_order(spark: SparkSession, base: str) -> DataFrame:
    """SNK-3 + SRT-1: the filled days written per day in (time, grid) order, read back by file and row: rows, sums and whether
    every row follows the one before it in its file."""
    from gridloom.plans.queries import _filled_steps

    folder = f"{scratch_path(spark, 'filled')}/daily"
    f = _filled_steps(spark, base)
    pages.write_daily(f, folder, "ts", order=["ts", "grid_id", "t", "speed"])
    back = spark.read.parquet(folder).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    place = F.struct("ts", "grid_id")
    before = F.lag(place).over(Window.partitionBy("file").orderBy("row"))  # one written file at a time
    ordered = back.withColumn("follows", F.coalesce(before < place, F.lit(True)))
    return present(ordered.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.sum("t").alias("t"), F.sum("speed").alias("speed"),
                                               F.bool_and("follows").alias("in_order")))


def q79_tensor_check(spark: SparkSession, base: str) -> DataFrame:
    """SNK-4 + SRC-13 + VAL-5: the values written to the tensor folder against those read back from it."""
    from gridloom.plans.queries import _filled_steps

    folder = _tensor_folder(spark, base)
    long, _report = tensorfiles.read_tensor_days(spark, folder, *TENSOR_SHAPE)
    f = _filled_steps(spark, base)
    given = f.select("date", "step", F.col("grid_id").alias("node"), F.posexplode(F.array(*[F.col(c).cast("float") for c in SAMPLE_FEATURES])).alias("feature", "value"))
    given = given.select("date", F.col("step").cast("long").alias("step"), F.col("node").cast("long").alias("node"), F.col("feature").cast("long").alias("feature"), "value")
    return present(tensorfiles.round_trip_equal(given, long, ["date", "step", "node", "feature"], "value").select("rows_written", "rows_read", "equal"))


def _write_grid_info(grids: DataFrame, folder: str) -> None:
    heads = list(pages.GRID_HEADERS)
    grids.select(F.col("grid_id").alias(heads[0]), F.col("lon_min").alias(heads[1]), F.col("lat_min").alias(heads[2]),
                 F.col("lon_max").alias(heads[3]), F.col("lat_max").alias(heads[4]),
                 F.col("grid_id").cast("string").alias(heads[5]), (F.col("grid_id") % 4).alias(heads[6]),
                 F.floor(F.col("grid_id") / 4).alias(heads[7])) \
        .write.mode("overwrite").option("header", True).csv(folder)


def q63_merge_cubes(spark: SparkSession, base: str) -> DataFrame:
    """SRC-7 + SRC-8 + AGG-5: reanalysis split by variable into two CSV sets, read back with a
    keep-list, combined by coordinates and merged to the first non-NULL value per column."""
    root = scratch_path(spark, "cubes")
    r = views.reanalysis(spark, base)
    keys = ["ts", "lon", "lat"]
    ordcols = [f"ord.{c}" for c in r.select("ord.*").columns]
    flat = r.select(*keys, "t2m", "d2m", "u10", "v10", "sp", "tp", *[F.col(c).alias(c.split(".")[1]) for c in ordcols])
    lcols = [c.split(".")[1] for c in ordcols]
    a = flat.select(*keys, "t2m", "d2m", *lcols)
    b = flat.select(*keys, "u10", "v10", "sp", "tp", *lcols)
    for name, part in (("a", a), ("b", b)):
        part.withColumn("ts", tx.ntz_text("ts")).withColumn("l_shipdate", tx.ntz_text("l_shipdate")) \
            .write.mode("overwrite").option("header", True).csv(f"{root}/{name}")
    keep = keys + ["t2m", "d2m", "u10", "v10", "sp", "tp", "msl"] + lcols
    parts = [pages.read_reanalysis(spark, f"{root}/{n}", keep) for n in ("a", "b")]
    u = dedup.union_slices(parts)
    numeric = {c: F.col(c).cast("double") for c in ["lon", "lat", "t2m", "d2m", "u10", "v10", "sp", "tp",
                                                      "l_quantity", "l_extendedprice", "l_discount", "l_tax"]}
    ints = {c: F.col(c).cast("bigint") for c in ["l_orderkey", "l_partkey", "l_suppkey"]}
    u = u.withColumns({**numeric, **ints, "l_linenumber": F.col("l_linenumber").cast("int"),
                       "l_shipdate": F.to_timestamp_ntz(F.col("l_shipdate")),
                       "ts": tx.parse_exact("ts")})
    u = u.withColumn("ord", F.struct(*[F.col(c) for c in lcols]))
    merged = grid.first_non_null(u, keys, "ord", ["t2m", "d2m", "u10", "v10", "sp", "tp"])
    return present(merged)


def q72_cube_conflicts(spark: SparkSession, base: str) -> DataFrame:
    """SRC-8: three cubes of one grid merged by coordinates; two of them hold the same variable and disagree on the 7th of
    each month, which the merge reports beside the value it takes."""
    m = grid.first_non_null(views.reanalysis(spark, base), ["ts", "lon", "lat"], "ord", ["t2m", "d2m", "sp", "tp"])
    other = m.withColumn("t2m", F.when(F.dayofmonth("ts") == 7, F.col("t2m") + 1).otherwise(F.col("t2m")))
    keys = ["ts", "lon", "lat"]
    cubes = [m.filter(F.col("lat") <= 20).select(*keys, "t2m", "d2m"), other.select(*keys, "t2m", "sp"), m.select(*keys, "tp", "d2m")]
    merged = grid.merge_cubes(cubes, keys)
    return present(merged.withColumn("conflicts", F.array_join("conflicts", ",")))


def q73_page_report(spark: SparkSession, base: str) -> DataFrame:
    """SRC-1/2 + JN-8 input: what became of every file of a folder that holds pages with their columns in another order,
    pages without the time column, unreadable times and a stray file, and the values read from each page."""
    root = scratch_path(spark, "odd-pages")
    o = views.obs(spark, base, 4)
    text = tx.ntz_text("ts")
    rows = o.select(text.alias("span_text"), F.when((F.col("page") % 7 == 3) & (F.col("row_ord") % 10 == 0), F.lit("n/a")).otherwise(text)
                    .alias("DDATETIME"), F.col("grid_id").alias("GRIDID"), F.col("t").alias("T"), "page", "row_ord")
    kind = F.when(F.col("page") % 5 == 2, 2).when(F.col("page") % 3 == 1, 1).otherwise(0)
    for k, columns in enumerate((["DDATETIME", "GRIDID", "T"], ["T", "DDATETIME", "GRIDID"], ["GRIDID", "T"])):
        written = pages.write_pages(rows.filter(kind == k), root, "page", "row_ord", columns, time_text="span_text")
        written.write.mode("overwrite").parquet(f"{root}_written/{k}")
    rows.limit(1).select("GRIDID", "T").coalesce(1).write.mode("append").option("header", True).csv(root)  # a stray file
    report = pages.file_report(spark, root).select(pages.parse_page_name(F.col("file_name"))[0], "status", "rows", "skipped", "rows_without_time")
    read = pages.read_pages(spark, root).groupBy("page").agg(F.sum("T").alias("t_sum"), F.max("GRIDID").alias("max_grid"))
    return present(report.join(read, "page", "left"), digits=4)


IO_QUERIES = {
    "q45_json_pages": q45_json_pages,
    "q46_stream_dedup": q46_stream_dedup,
    "q47_stream_completeness": q47_stream_completeness,
    "q66_stream_report": q66_stream_report,
    "q67_stream_late": q67_stream_late,
    "q48_tensor_roundtrip": q48_tensor_roundtrip,
    "q68_prediction_samples": q68_prediction_samples,
    "q69_masked_samples": q69_masked_samples,
    "q61_page_file_roundtrip": q61_page_file_roundtrip,
    "q62_catalog_dispatch": q62_catalog_dispatch,
    "q63_merge_cubes": q63_merge_cubes,
    "q72_cube_conflicts": q72_cube_conflicts,
    "q76_series_check": q76_series_check,
    "q77_grid_info": q77_grid_info,
    "q78_daily_order": q78_daily_order,
    "q79_tensor_check": q79_tensor_check,
    "q73_page_report": q73_page_report,
}
