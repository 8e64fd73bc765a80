"""End-to-end jobs on files built from the driver's events table (sf0.001)."""

import numpy as np
import pyspark.sql.functions as F

from gridloom.functions import timeaxis as tx
from gridloom.plans import jobs, views
from gridloom.plans.io_queries import PAGE_COLS
from gridloom.session import scratch_path
from gridloom.sources import pages, tensorfiles
from tests.conftest import SMALL


def _station_pages(spark, root):
    o = views.obs(spark, SMALL, 4)
    rows = o.select(tx.ntz_text("ts").alias("DDATETIME"), F.col("grid_id").alias("GRIDID"), F.col("t").alias("T"),
                    F.col("t").alias("MAXTOFDAY"), F.col("slp").alias("SLP"), F.col("rh").alias("RHSFC"),
                    (F.col("speed") / 10).alias("V"), F.col("speed").alias("WSPD"), F.col("dir").alias("WDIR"),
                    (F.col("speed") * 1.5).alias("WD3SMAXDF"), F.col("dir").alias("WD3SMAXDD"),
                    *[F.col("rain").alias(c) for c in ("RAIN01H", "RAIN02H", "RAIN03H", "RAIN06H", "RAIN24H")],
                    "page", "row_ord")
    pages.write_pages(rows, f"{root}/raw", "page", "row_ord", PAGE_COLS).collect()
    heads = list(pages.GRID_HEADERS)
    views.grid_dim(o).select(
        F.col("grid_id").alias(heads[0]), F.col("lon_min").alias(heads[1]), F.col("lat_min").alias(heads[2]),
        F.col("lon_max").alias(heads[3]), F.col("lat_max").alias(heads[4]), F.col("grid_id").cast("string").alias(heads[5]),
        F.lit(0).alias(heads[6]), F.lit(0).alias(heads[7])).write.option("header", True).csv(f"{root}/grid")


def test_station_jobs_end_to_end(spark):
    root = scratch_path(spark, "t-jobs")
    _station_pages(spark, root)
    report = jobs.daily_split(spark, f"{root}/raw", f"{root}/daily", f"{root}/stats", max_grid_id=3, step_minutes=60)
    assert report.count() == 30
    status, ignored = jobs.fill_days(spark, f"{root}/daily", f"{root}/grid", f"{root}/stats", f"{root}/filled",
                                     max_grid_id=3, step_minutes=60, threshold=0.9)
    ok_days = status.filter("success").count()
    assert ok_days + status.filter("not success").count() + ignored.count() == 30
    filled = spark.read.parquet(f"{root}/filled")
    grid_rows = filled.filter("not is_mean_field")
    assert grid_rows.count() == ok_days * 24 * 4
    assert grid_rows.filter(F.col("T").isNull() | F.col("AIR_DENSITY").isNull()).count() == 0
    assert filled.filter("is_mean_field").count() == ok_days * 24
    st = jobs.station_tensors(spark, f"{root}/filled", f"{root}/tensors", steps=24, grids=4)
    assert st.filter("status = 'success'").count() == ok_days
    meta = tensorfiles.read_metadata(spark, f"{root}/tensors/metadata")
    assert meta["num_features"] == 17 and meta["feature_names"][3] == "AIR_DENSITY"
    day = st.filter("status = 'success'").orderBy("date").first()["file_name"]
    path = f"{root}/tensors/{day}"
    raw = spark.read.format("binaryFile").load(path).first()["content"]
    arr = np.frombuffer(raw, dtype=np.float32).reshape(24, 4, 17)
    assert np.isfinite(arr).all()
    smp, nodes = jobs.training_samples(spark, f"{root}/tensors", 24, 4, 17, mode="spatial", mask_rate=0.5)
    assert smp.count() == ok_days * 24 and nodes.count() == 4
    row = smp.first()
    assert len(row["mask"]) == 4 and len(row["datetime"]) == 1 and len(row["target"][0]) == 4 and len(row["stats"]) == 17
    hidden = [x for m, v in zip(row["mask"], row["data"][0]) if m for x in v]
    assert not any(hidden)
    win, _ = jobs.training_samples(spark, f"{root}/tensors", 24, 4, 17, mode="sliding", input_len=4, pred_len=2, stride=2, train_share=0.6)
    first = win.first()
    assert len(first["data"]) == 4 and len(first["target"]) == 2 and len(first["datetime"]) == 6
    assert win.count() == ok_days * 10
    tumbling, _ = jobs.training_samples(spark, f"{root}/tensors", 24, 4, 17, mode="tumbling", input_len=4, pred_len=2)
    assert tumbling.count() == ok_days * 4


def test_reanalysis_tensors(spark):
    root = scratch_path(spark, "t-rean")
    r = views.reanalysis(spark, SMALL)
    raw = r.select(F.col("ts").alias("valid_time"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
                   "t2m", "d2m", "u10", "v10", "sp", "tp", "ord", F.lit(1).alias("expver"))
    st = jobs.reanalysis_tensors(spark, raw, f"{root}/t", steps=1, grids=16, order="ord")
    counts = {r["status"]: r["n"] for r in st.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts.get("success", 0) > 0
    long, report = tensorfiles.read_tensor_days(spark, f"{root}/t", 1, 16, len(jobs.REANALYSIS_FEATURES))
    assert long.count() == counts["success"] * 16 * len(jobs.REANALYSIS_FEATURES)
