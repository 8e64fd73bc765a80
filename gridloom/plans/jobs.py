"""End-to-end jobs: the reference's entry points as single Spark plans.

* ``daily_split`` — raw pages → keep-first dedup → day partitions + completeness report (§3.1)
* ``fill_days`` — day table → quality gate → scaffold → wind components → space-time fill →
  air density + mean field → filled day partitions (§3.2)
* ``station_tensors`` / ``reanalysis_tensors`` — day tables → derived features, units, log →
  day tensors with metadata, time index and coordinates (§3.3)
* ``training_samples`` — day tensors → step samples with masks, or sliding / tumbling windows (§3.3)

Each job reads every input once and writes with Spark writers (or, for tensor files, from
tasks); per-day work that the reference spreads over processes is spread over partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import physics as phy
from gridloom.functions import timeaxis as tx
from gridloom.operators import dedup, features, grid, interp, moments, quality, scaffold
from gridloom.operators.interp import Method
from gridloom.operators.samples import Windowing
from gridloom.sources import pages, tensorfiles
from gridloom.sources.dataset import TensorSamples
from gridloom.sources.schemas import STATION_MEASURES

# The station fill configuration — per-column methods and (speed, direction) pairs.
STATION_FILL_METHODS = {
    "T": Method("cubic"), "MAXTOFDAY": Method("cubic"), "SLP": Method("cubic"),
    "RHSFC": Method("spline", 2), "V": Method("linear"),
    "RAIN01H": Method("linear"), "RAIN02H": Method("linear"), "RAIN03H": Method("linear"),
    "RAIN06H": Method("linear"), "RAIN24H": Method("linear"),
}
STATION_VECTORS = [("WSPD", "WDIR", "linear"), ("WD3SMAXDF", "WD3SMAXDD", "linear")]
# Station tensor features in channel order, and the long-tail columns among them.
STATION_FEATURES = ["T", "MAXTOFDAY", "SLP", "AIR_DENSITY", "RHSFC", "WSPD_X", "WSPD_Y", "WSPD",
                    "WD3SMAXDF_X", "WD3SMAXDF_Y", "GUST", "V", "RAIN01H", "RAIN02H", "RAIN03H", "RAIN06H", "RAIN24H"]
STATION_LOG = ["V", "RAIN01H", "RAIN02H", "RAIN03H", "RAIN06H", "RAIN24H"]
# Reanalysis tensor features in channel order, and the long-tail columns among them.
REANALYSIS_FEATURES = ["u10", "v10", "ws", "t2m", "d2m", "rh", "sp", "msl", "i10fg", "cape", "tp", "ssrd",
                       "lcc", "tcc", "blh", "tcwv", "skt", "z", "lsm"]
REANALYSIS_LOG = ["ssrd", "tp", "cape", "i10fg"]


def daily_split(spark: SparkSession, pages_folder: str, daily_out: str, stats_out: str,
                max_grid_id: int = 4231, step_minutes: int = 10) -> DataFrame:
    """§3.1: every page read once, duplicates resolved by (span start, page, row), one folder per day.

    Returns the completeness report (also written as CSV to ``stats_out``).  Beside it, ``stats_out`` with
    ``_files`` appended gets the status of every file, its rows and those without a usable time.
    """
    pages.file_report(spark, pages_folder).write.mode("overwrite").parquet(f"{stats_out.rstrip('/')}_files")
    raw = pages.read_pages(spark, pages_folder).filter(F.col("ts").isNotNull())
    d = dedup.dedup_keep_first(raw, ["ts", "GRIDID"], ["span_start", "page", "row_ord"])
    keep = ["ts", "GRIDID", *STATION_MEASURES]
    pages.write_daily(d, daily_out, "ts", order=keep)
    daily = pages.read_daily(spark, daily_out, keep)
    report = quality.completeness(daily, "ts", "GRIDID", max_grid_id=max_grid_id, step_minutes=step_minutes)
    pages.write_completeness(report, stats_out)
    return report


def fill_days(spark: SparkSession, daily_path: str, grid_info_path: str, stats_path: str, out_path: str,
              max_grid_id: int = 4231, step_minutes: int = 10, threshold: float = 0.95,
              methods: dict[str, Method] | None = None,
              vectors: list[tuple[str, str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """§3.2: days passing the completeness gate, filled in space and time, with air density and
    the per-time mean field; written per day in the fixed column order.

    Returns (per-day fill status, ignored days).
    """
    methods = dict(methods or STATION_FILL_METHODS)
    vectors = vectors or STATION_VECTORS
    for speed, _direction, how in vectors:
        methods[f"{speed}_X"] = Method(how)
        methods[f"{speed}_Y"] = Method(how)
    keep = ["ts", "GRIDID", *STATION_MEASURES]
    daily = pages.read_daily(spark, daily_path, keep)
    stats = pages.read_completeness(spark, stats_path).withColumn("date", F.to_date("date", "yyyyMMdd"))
    kept, ignored = quality.completeness_filter(daily, stats, "ts", threshold)
    d = quality.sentinel_to_null(kept, ["SLP", "RHSFC"]).withColumnRenamed("GRIDID", "grid_id")
    grid_info = pages.read_grid_info(spark, grid_info_path)
    a = scaffold.align(d, grid_info, step_minutes, max_grid_id)
    a = phy.wind_components(a, [(s, v) for s, v, _ in vectors], ("_X", "_Y"))
    filled, status = interp.st_fill(a, methods, "date", "grid_id", "ts", "lon_center", "lat_center")
    filled = filled.withColumn("AIR_DENSITY", phy.air_density("T", "SLP", "RHSFC"))
    value_cols = list(methods) + ["AIR_DENSITY"]
    out = features.with_mean_field(filled, "ts", value_cols)
    order = ["ts", "grid_id", "lon_min", "lat_min", "lon_max", "lat_max", "lon_center", "lat_center",
             *value_cols, "is_mean_field"]
    pages.write_daily(out, out_path, "ts", order=order)
    return status, ignored


def station_tensors(spark: SparkSession, filled_path: str, out_folder: str, steps: int = 144,
                    grids: int = 4232, feature_names: list[str] | None = None) -> DataFrame:
    """§3.3 (station): mean field dropped, SLP in kPa, speeds from components, long tails log1p'd
    after clipping at 0, absent features 0; one float32 [T, G, F] file per day plus sidecars.

    Returns the per-day write status (VAL-1/VAL-2 reasons for days that do not fit).
    """
    names = feature_names or STATION_FEATURES
    d = features.drop_mean_field(spark.read.parquet(filled_path))
    d = phy.convert_units(d, {"SLP": phy.STATION_UNITS["slp"]})
    d = d.withColumns({"WSPD": phy.magnitude("WSPD_X", "WSPD_Y"), "GUST": phy.magnitude("WD3SMAXDF_X", "WD3SMAXDF_Y")})
    d = phy.log1p_columns(d, STATION_LOG, clip_at_zero=True)
    d = features.add_missing_zero(d, names).withColumn("step", tx.step_of_day("ts", 1440 // steps).cast("bigint"))
    return _write_tensors(spark, d, out_folder, steps, grids, names, "lon_center", "lat_center",
                          {"log_transformed_features": STATION_LOG,
                           "units_note": "T degC, SLP kPa, RHSFC %, speeds m/s, V log1p(km), RAIN log1p(mm)"})


def reanalysis_tensors(spark: SparkSession, raw: DataFrame, out_folder: str, steps: int = 24, grids: int = 2664,
                       feature_names: list[str] | None = None, order: str | None = None) -> DataFrame:
    """§3.3 (reanalysis): names unified, duplicate keys merged to the first non-NULL value
    (``order`` gives the source order), RH and wind speed derived, unit rules and log1p applied,
    each day cut to its last T×G rows, grid ids ranked by (lat, lon); tensors plus sidecars.
    """
    names = feature_names or REANALYSIS_FEATURES
    r = features.unify_names(features.drop_columns(raw))
    values = [c for c in r.columns if c not in ("ts", "lon", "lat") and c != order]
    if order:
        r = grid.first_non_null(r, ["ts", "lon", "lat"], order, values)
    r = r.withColumns({"rh": phy.relative_humidity("t2m", "d2m"), "ws": phy.magnitude("u10", "v10")}) \
        if {"t2m", "d2m", "u10", "v10"} <= set(r.columns) else r
    r = phy.log1p_columns(phy.convert_units(r, phy.REANALYSIS_UNITS), REANALYSIS_LOG, clip_at_zero=False)
    r = grid.tail_truncate(r, "ts", ["lon", "lat"], steps, grids)
    r = grid.attach_grid_ids(r, "lon", "lat")
    r = features.add_missing_zero(r, names).withColumn("date", F.to_date("ts"))
    r = r.withColumn("step", tx.step_of_day("ts", 1440 // steps).cast("bigint"))
    return _write_tensors(spark, r, out_folder, steps, grids, names, "lon", "lat",
                          {"log_transformed_features": REANALYSIS_LOG,
                           "units_note": "temperatures degC, pressures kPa (Pa/1000), z km, tp log1p(mm), "
                                         "ssrd log1p(W/m2), rh %, blh m"})


def _write_tensors(spark: SparkSession, d: DataFrame, out_folder: str, steps: int, grids: int,
                   names: list[str], lon: str, lat: str, extra_meta: dict) -> DataFrame:
    d = d if "date" in d.columns else d.withColumn("date", F.to_date("ts"))
    status = tensorfiles.write_tensor_days(d, out_folder, steps, grids, names)
    status.write.mode("overwrite").parquet(f"{out_folder}/_status")
    # coordinates of each grid id; SNK-7 keeps one per id and reports ids with more than one
    coords = d.groupBy("grid_id").agg(F.min(lon).cast("float").alias("lon"), F.min(lat).cast("float").alias("lat"),
                                      F.count_distinct(lon, lat).alias("n_variants"))
    meta = {"num_features": len(names), "num_grids": grids, "time_steps_per_day": steps,
            "feature_names": names, "coord_names": ["lon", "lat"], "dtype": "float32", **extra_meta}
    tensorfiles.write_sidecars(spark, out_folder, d.select("date", "ts"), coords, meta)
    return spark.read.parquet(f"{out_folder}/_status")


def training_samples(spark: SparkSession, tensor_folder: str, steps: int, grids: int, n_features: int,
                     mode: str = "spatial", input_len: int = 12, pred_len: int = 12, stride: int = 1,
                     mask_rate: float = 0.2, seed: int = 0, train_share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """§3.3 training side: day tensors as step samples with a node mask (``spatial``), sliding windows
    inside a day (``sliding``) or tumbling windows (``tumbling``).

    Returns (samples, nodes).  A sample has its id, date, first step, the time of every step, ``data``,
    ``target`` and in spatial mode the node mask, normalised per feature (NRM-1) with the statistics of
    the first ``train_share`` of the days, which it carries as ``stats`` for the way back.  ``nodes``
    has the coordinates and elevation of every node, in tensor order.
    """
    shape = (steps, grids, n_features)
    if mode not in ("spatial", "sliding", "tumbling"):
        raise ValueError(f"unknown sample mode {mode!r}")
    length = input_len + pred_len
    windowing = {"spatial": Windowing(1), "sliding": Windowing(input_len, pred_len, stride),
                 "tumbling": Windowing(input_len, pred_len, length)}[mode]
    data = TensorSamples(spark, tensor_folder, *shape, windowing, tumbling=mode == "tumbling")
    if len(data) == 0:
        raise ValueError(f"no valid tensor file of {steps * grids * n_features * 4} bytes in {tensor_folder}")
    packed = tensorfiles.read_tensor_steps(spark, tensor_folder, *shape)
    if train_share < 1:
        files = tensorfiles.tensor_files(spark, tensor_folder, *shape).filter("status = 'success'")
        packed = packed.filter(F.col("date") < moments.train_boundary(files.select(F.to_date("stem", "yyyyMMdd").alias("d")), "d", train_share))
    stats = moments.vector_moments(packed, "features").select("stats").scalar()
    samples = data.samples(mask_rate=mask_rate if mode == "spatial" else None, seed=seed, stats=stats)
    return samples, data.coordinates()
