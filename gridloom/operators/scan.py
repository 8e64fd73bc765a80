"""Parallel prefix sums: running totals over a table that no single task holds.

Rows are dealt by range of the order, each range is summed where it lies, and the totals of the
ranges before are added.  There are as many ranges as shuffle partitions, and their totals are
the only thing that meets in one place: P numbers, whatever the table holds.  The dealt table is
checkpointed, because ranges are drawn from a sample and must be the same in both passes.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridloom.session import cut_lineage


def prefix_sums(df: DataFrame, order: list[str], value: str, out: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows earlier in ``order`` (0 for the first).

    ``order`` must tell all rows apart; null values count as 0.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))
    amount = F.coalesce(F.col(value), F.lit(0))
    totals = sorted((r[0], r[1]) for r in dealt.groupBy("__range").agg(F.sum(amount)).collect())  # one number per range
    starts = [0, *accumulate(t for _, t in totals)]
    offsets = spark.createDataFrame([(r, s) for (r, _), s in zip(totals, starts)], "__range int, __start long")
    earlier = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("__inside", F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
    return (inside.join(F.broadcast(offsets), "__range")  # at most P rows
            .withColumn(out, (F.col("__start") + F.col("__inside")).cast("long")).drop("__range", "__start", "__inside"))
