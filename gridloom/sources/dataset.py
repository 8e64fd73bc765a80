"""Training samples straight from a folder of day tensors: length, ranges of ids, complete samples (SMP-1..6, JN-10/11).

``TensorSamples`` offers what a map-style data set offers — a length and samples by id — as
DataFrames.  The index knows every sample's place, so a range of ids reads the byte ranges of the
days and steps it needs and builds no other window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import geo
from gridloom.operators import moments
from gridloom.operators.samples import SampleIndex, Windowing
from gridloom.operators.tensors import check_window
from gridloom.sources import tensorfiles


class TensorSamples:
    """Samples of all whole days of a folder, windows never crossing a day.

    ``windowing`` cuts the windows; with ``tumbling`` its length must divide the day (VAL-4).  A
    sample has sample_id, date, start, ``data`` and ``target`` (``[L][G][F]``, nulls where a value
    is missing), ``datetime`` (the time of each of its steps) and, on request, the ``mask`` of its
    nodes.  Coordinates and elevations are one array per folder, shared by all samples.
    """

    def __init__(self, spark: SparkSession, folder: str, steps: int, grids: int, n_features: int, windowing: Windowing,
                 tumbling: bool = False):
        check_window(steps, windowing.length, tumbling)
        self.spark, self.folder, self.windowing = spark, folder.rstrip("/"), windowing
        self.shape = (steps, grids, n_features)
        days = tensorfiles.tensor_files(spark, folder, steps, grids, n_features).filter("status = 'success'")
        days = days.select(F.to_date("stem", "yyyyMMdd").alias("date"), F.lit(steps).alias("n_steps")).filter("date is not null")
        self.index = SampleIndex(days, ["date"], "n_steps", windowing)

    def __len__(self) -> int:
        return len(self.index)

    def steps(self, low: int = 0, high: int | None = None) -> DataFrame:
        """The packed steps that a range of ids needs: days, and steps if it lies in one day, are pruned at the files."""
        bounds = {}
        if low > 0 or high is not None:
            first, last, n, w0, w1 = self.index.groups(low, high).agg(
                F.min("date"), F.max("date"), F.count(F.lit(1)), F.min("first_window"), F.max("last_window")).first()
            if n == 0:
                return tensorfiles.read_tensor_steps(self.spark, self.folder, *self.shape, first_step=1, last_step=0)
            bounds = {"first_day": first, "last_day": last}
            if n == 1:
                bounds |= {"first_step": w0 * self.windowing.stride, "last_step": w1 * self.windowing.stride + self.windowing.length - 1}
        return tensorfiles.read_tensor_steps(self.spark, self.folder, *self.shape, **bounds)

    def samples(self, low: int = 0, high: int | None = None, mask_rate: float | None = None, seed: int = 0,
                stats: Column | None = None) -> DataFrame:
        """Complete samples ``low <= sample_id < high`` (all without bounds).

        With ``mask_rate`` the nodes of each sample are masked (MSK-1): masked values are 0 in ``data``, ``target``
        keeps the true values of all steps, as in the spatial task; without it ``target`` holds the steps to predict.
        ``stats`` (moments per feature) normalises the values before they are masked and stays beside each sample.
        """
        times = tensorfiles.read_time_index(self.spark, f"{self.folder}/time_index")
        packed = self.steps(low, high).join(times, ["date", "step"], "left")
        if stats is not None:
            scaled = moments.normalise(packed.withColumn("stats", stats), "features", "stats", "z", nested=True)
            packed = scaled.select("date", "step", F.col("z").cast("array<array<float>>").alias("features"), "ts")
        rows = self.index.read(packed, "step", low, high)
        entry = F.struct("k", "features", "ts")
        s = rows.groupBy("sample_id", "date", "start").agg(F.array_sort(F.collect_list(entry), lambda a, b: a["k"] - b["k"]).alias("w"))
        seq, n = F.transform("w", lambda e: e["features"]), self.windowing.input_len
        s = s.select("sample_id", "date", "start", seq.alias("all"), F.transform("w", lambda e: e["ts"]).alias("datetime"))
        extra = [] if stats is None else ["stats"]
        s = s if stats is None else s.withColumn("stats", stats)
        if mask_rate is None:
            return s.select("sample_id", "date", "start", "datetime", *extra, F.slice("all", 1, n).alias("data"),
                            F.slice("all", n + 1, self.windowing.pred_len).alias("target"))
        nodes = F.transform(F.sequence(F.lit(0), F.lit(self.shape[1] - 1)),
                            lambda g: geo.sensor_mask(F.col("sample_id"), g, mask_rate, seed))
        s = s.withColumn("mask", nodes)
        hidden = F.transform("all", lambda step: F.transform(step, lambda v, g: F.transform(
            v, lambda x: geo.apply_mask(x, F.element_at("mask", g + 1)).cast("float"))))
        return s.select("sample_id", "date", "start", "datetime", *extra, hidden.alias("data"), F.col("all").alias("target"), "mask")

    def coordinates(self) -> DataFrame:
        """(node, lon, lat, elevation): the nodes in tensor order; elevation is null without its sidecar."""
        return tensorfiles.read_nodes(self.spark, self.folder)
