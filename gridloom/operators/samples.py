"""Sample index: a length and a place for every training window, before any window is built (§2.13).

A day (or a whole series) of S steps has a known number of windows, so the prefix sums of these
numbers map a global ``sample_id`` to (group, start) and back.  The index has one row per group;
a range of ids is located in it and only the steps that the range needs are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.scan import prefix_sums
from gridloom.operators.tensors import check_window


@dataclass(frozen=True)
class Windowing:
    """How windows are cut from a group of steps: ``input_len`` + ``pred_len`` steps every ``stride``.

    ``stride`` of the window's length is tumbling, 1 the densest sliding; ``input_len`` 1 and
    ``pred_len`` 0 is one sample per step (SMP-1).
    """

    input_len: int
    pred_len: int = 0
    stride: int = 1

    @property
    def length(self) -> int:
        return self.input_len + self.pred_len

    def count(self, steps: Column) -> Column:
        """Windows of a group of ``steps`` steps."""
        return F.greatest(F.floor((steps - self.length) / self.stride) + 1, F.lit(0)).cast("long")


class SampleIndex:
    """Windows of all groups in the order of their keys, numbered from 0."""

    def __init__(self, groups: DataFrame, keys: list[str], steps: str, windowing: Windowing, steps_per_group: int | None = None):
        if steps_per_group is not None:
            check_window(steps_per_group, windowing.length)
        self.keys, self.windowing = keys, windowing
        counted = groups.select(*keys, windowing.count(F.col(steps)).alias("n_windows")).filter("n_windows > 0")
        self.table = prefix_sums(counted, keys, "n_windows", "first_id")
        self._length: int | None = None

    def __len__(self) -> int:
        """Number of samples (one number from the index, asked for once)."""
        if self._length is None:
            self._length = int(self.table.agg(F.coalesce(F.sum("n_windows"), F.lit(0))).first()[0])
        return self._length

    def groups(self, low: int = 0, high: int | None = None) -> DataFrame:
        """Groups that hold ids ``low <= id < high``, with the first and last window of each that does."""
        rows = self.table if high is None else self.table.filter(F.col("first_id") < high)
        rows = rows.filter(F.col("first_id") + F.col("n_windows") > low)
        last = F.col("n_windows") - 1 if high is None else F.least(F.col("n_windows") - 1, F.lit(high - 1) - F.col("first_id"))
        return rows.select(*self.keys, "first_id", F.greatest(F.lit(low) - F.col("first_id"), F.lit(0)).alias("first_window"),
                           last.alias("last_window"))

    def locate(self, low: int = 0, high: int | None = None) -> DataFrame:
        """(sample_id, keys, start): the place of every id in the range."""
        rows = self.groups(low, high).withColumn("w", F.explode(F.sequence("first_window", "last_window")))
        return rows.select((F.col("first_id") + F.col("w")).alias("sample_id"), *self.keys,
                           (F.col("w") * self.windowing.stride).alias("start"))

    def read(self, steps: DataFrame, step: str, low: int = 0, high: int | None = None) -> DataFrame:
        """The rows of ``steps`` that the samples of a range hold: sample_id, keys, start, k, part and all other columns.

        ``steps`` is joined on (keys, step); a step that is absent gives no row.
        """
        places = self.locate(low, high)
        want = places.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(self.windowing.length - 1))))
        want = want.withColumn(step, (F.col("start") + F.col("k")).cast(steps.schema[step].dataType))
        part = F.when(F.col("k") < self.windowing.input_len, F.lit("input")).otherwise(F.lit("target"))
        return steps.join(want.withColumn("part", part), [*self.keys, step])
