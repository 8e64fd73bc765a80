"""Plan properties: no cross products, pruned scans, map-side combining under a hot key."""

import datetime as dt

import pytest
import pyspark.sql.functions as F

import __spark_entry__ as entry
from gridloom.operators import dedup, quality
from tests.conftest import SMOKE

QUERIES = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products(spark, name):
    plan = _plan(QUERIES[name](spark, SMOKE))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    """The flagship query needs three event columns; the scan must not read the others."""
    plan = _plan(QUERIES["q01_completeness_daily"](spark, SMOKE))
    schemas = [line for line in plan.split("\n") if "ReadSchema" in line or "FileScan" in line]
    assert schemas and all("props" not in line and "event_type" not in line for line in schemas)


def test_hot_key_is_combined_map_side(spark):
    """A third of the rows on one (ts, grid) key: the dedup and the report stay exact, and the
    plan aggregates partially before its shuffle."""
    t0 = dt.datetime(2024, 1, 1)
    hot = spark.range(0, 30000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(t0)).otherwise(
            F.lit(t0) + F.make_dt_interval(F.lit(0), (F.col("id") % 24).cast("int"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 4).cast("bigint").alias("grid_id"),
        (F.col("id") * 0.5).alias("v"), (F.col("id") % 7).alias("page"), F.col("id").alias("row_ord"))
    d = dedup.dedup_keep_first(hot, ["ts", "grid_id"], ["page", "row_ord"])
    plan = _plan(d)
    assert "partial_min" in plan
    first = d.filter((F.col("ts") == t0) & (F.col("grid_id") == 0)).first()
    assert first["row_ord"] == 0
    assert d.count() == hot.select("ts", "grid_id").distinct().count()
    rep = quality.completeness(d, "ts", "grid_id", max_grid_id=3, step_minutes=60).first()
    # hours present: 0 and the 16 hours h in 1..23 with h mod 3 != 0, one cell each
    assert rep["actual_points"] == 17 and rep["missing_time_points_count"] == 7
    assert rep["incomplete_time_points_count"] == 17


def test_alignment_reads_its_input_once(spark):
    """The days and the cells of the scaffold come from one aggregate whose exchange is reused: the observations are read
    once (and once for the page spans), not once a side."""
    df = QUERIES["q12_linear_fill"](spark, SMOKE)
    df.collect()
    plan = _plan(df).split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 1 and plan.count("FileScan") <= 3


def test_no_window_holds_everything(spark):
    """No query sends its rows to one partition for a window (the interval sweep of q10 orders distinct days only)."""
    for name in ("q12_linear_fill", "q19_grid_ids", "q20_tail_truncate", "q23_location_batches", "q54_step_index", "q68_prediction_samples"):
        lines = _plan(QUERIES[name](spark, SMOKE)).split("\n")
        windows = [k for k, line in enumerate(lines) if " Window [" in line]
        assert not [k for k in windows if any("SinglePartition" in line for line in lines[k:k + 4])], name


def test_dimension_join_broadcasts_only_under_the_estimate(spark):
    from gridloom.operators.joins import dimension_join, estimated_bytes

    fact = spark.range(0, 100000).withColumn("k", F.col("id") % 10)
    dim = spark.range(0, 10).withColumnRenamed("id", "k").withColumn("name", F.col("k").cast("string"))
    assert estimated_bytes(dim) is not None
    small = _plan(dimension_join(fact, dim, "k", "left"))
    assert "BroadcastHashJoin" in small
    capped = dimension_join(fact, dim, "k", "left", max_bytes=0)
    hinted = capped._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in hinted.lower()
