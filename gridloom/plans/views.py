"""Views that give the driver's tables the shapes the operators expect.

Each view is derived from a given table by column expressions only, so its size
grows with the table.  The SQL text of the same views lives in
``gridloom.plans.oracle`` and must stay in step with this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import timeaxis as tx
from gridloom.sources.tables import read_table

# Fixed values of the `grid` view: origin and cell width of the synthetic grid (degrees).
GRID_LON0 = 113.75
GRID_LAT0 = 22.45
GRID_WIDTH = 0.05


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def obs(spark: SparkSession, base: str, n_grids: int = 4) -> DataFrame:
    """Station-like observations: hourly time, grid id, measures and page bookkeeping."""
    return obs_from_events(read_table(spark, base, "events", EVENT_COLS), n_grids)


def obs_from_events(e: DataFrame, n_grids: int = 4) -> DataFrame:
    """The ``obs`` projection of an events DataFrame (batch or stream)."""
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        tx.trunc_hour("ts").alias("ts"),
        (F.col("user_id") % n_grids).cast("bigint").alias("grid_id"),
        (F.col("value") / 10.0).alias("t"),
        k.cast("double").alias("rh"),
        F.when(k == 99, F.lit(0.0)).otherwise(F.lit(990.0) + k * 0.3).alias("slp"),
        F.col("value").alias("speed"),
        (k * 3.6).alias("dir"),
        F.when(F.col("event_type") == "error", F.col("value")).otherwise(F.lit(0.0)).alias("rain"),
        F.expr("event_id div 1000").cast("bigint").alias("page"),
        F.col("event_id").alias("row_ord"),
    )


def with_page_span(o: DataFrame) -> DataFrame:
    """Attach each page's first time (the span start carried by a page's file name)."""
    spans = o.groupBy("page").agg(F.min("ts").alias("span_start"))
    return o.join(spans, "page")


def grid_dim(o: DataFrame) -> DataFrame:
    """Grid dimension (A2-like) for the grid ids that occur in ``o``."""
    ids = o.select("grid_id").distinct()
    lon_min = F.lit(GRID_LON0) + F.lit(GRID_WIDTH) * (F.col("grid_id") % 4)
    lat_min = F.lit(GRID_LAT0) + F.lit(GRID_WIDTH) * F.floor(F.col("grid_id") / 4)
    return ids.select("grid_id", lon_min.alias("lon_min"), lat_min.alias("lat_min"),
                      (lon_min + GRID_WIDTH).alias("lon_max"), (lat_min + GRID_WIDTH).alias("lat_max"))


def grids(spark: SparkSession, base: str, n_grids: int) -> DataFrame:
    """Grid dimension of the ``obs`` view, read off the user ids alone."""
    return grid_dim(read_table(spark, base, "events", ["user_id"]).select((F.col("user_id") % n_grids).cast("bigint").alias("grid_id")))


def elevations(spark: SparkSession, base: str, n_grids: int) -> DataFrame:
    """Elevation per grid id (A3-like): the balance of the supplier next to the id."""
    return read_table(spark, base, "supplier", ["s_suppkey", "s_acctbal"]).filter(F.col("s_suppkey") <= n_grids).select(
        (F.col("s_suppkey") - 1).cast("bigint").alias("grid_id"), F.col("s_acctbal").cast("double").alias("elevation"))


def coords(spark: SparkSession, base: str, table: str = "supplier") -> DataFrame:
    """Point coordinates from customer or supplier keys."""
    key = {"supplier": "s_suppkey", "customer": "c_custkey"}[table]
    k = F.col(key)
    return read_table(spark, base, table, [key]).select(
        k.cast("bigint").alias("id"),
        ((k * 7) % 360).cast("double").alias("lon"),
        ((k * 11) % 181 - 90).cast("double").alias("lat"),
    )


def reanalysis(spark: SparkSession, base: str) -> DataFrame:
    """Reanalysis-like long table (A5): several rows per (ts, lon, lat) with gaps to merge."""
    li = read_table(spark, base, "lineitem")
    t2m = F.lit(273.15) + F.col("l_quantity")
    ordkey = F.struct(*[F.col(c) for c in li.columns])
    return li.select(
        F.col("l_shipdate").alias("ts"),
        ((F.col("l_suppkey") % 8) * 5).cast("double").alias("lon"),
        (F.col("l_linenumber") * 5).cast("double").alias("lat"),
        F.when(F.col("l_linestatus") != "F", t2m).alias("t2m"),
        (t2m - F.col("l_discount") * 200.0).alias("d2m"),
        ((F.col("l_partkey") % 21) - 10).cast("double").alias("u10"),
        ((F.col("l_orderkey") % 17) - 8).cast("double").alias("v10"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("sp"),
        (F.col("l_tax") / 100.0).alias("tp"),
        ordkey.alias("ord"),
    )


def daily_series(spark: SparkSession, base: str, nodes: int = 8) -> DataFrame:
    """Series-like long table (A7): per day and node two channels (quantity, price sums).

    ``step`` is the day offset from the first day, computed with a scalar subquery
    (one value, read off the scan) instead of an unpartitioned window.
    """
    li = read_table(spark, base, "lineitem", ["l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice"])
    day = F.to_date("l_shipdate")
    agg = li.groupBy(day.alias("day"), (F.col("l_suppkey") % nodes).cast("bigint").alias("node")).agg(
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("price"))
    first_day = li.agg(F.min(day)).scalar()  # straight off the scan, not off the aggregate
    long = agg.select(
        F.datediff("day", first_day).cast("bigint").alias("step"),
        F.col("day").cast("timestamp_ntz").alias("ts"), "node",
        F.inline(F.array(F.struct(F.lit(0).cast("bigint").alias("channel"), F.col("qty").alias("value")),
                         F.struct(F.lit(1).cast("bigint").alias("channel"), F.col("price").alias("value")))))
    return long
