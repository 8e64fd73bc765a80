"""Results that a stream keeps up to date, and the sink that holds their latest version.

A stateful plan in ``update`` mode emits a key again whenever its result changes.  The sink
writes each micro-batch to its own ``batch=<id>`` folder: a batch that is run again after a
failure overwrites the same folder, so every change is stored exactly once.  ``latest`` merges
the batches (latest wins) with a partial aggregate; ``compact`` writes that merge as one batch
of a new folder, so a long-running job reads no more history than it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert_sink(path: str, partition_by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores every batch once, in one pass over its plan."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch={batch_id}")
    return write


def run_updates(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Run an ``update``-mode plan over everything available now into an upsert folder, then stop."""
    q = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(upsert_sink(path, partition_by)).trigger(availableNow=True).start())
    q.awaitTermination()


def latest(spark: SparkSession, path: str, keys: list[str], only: str = "true") -> DataFrame:
    """The last version of every key among the rows that fulfil ``only``."""
    rows = spark.read.parquet(path).filter(only)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last"))
            .select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest]))


def compact(spark: SparkSession, path: str, keys: list[str], into: str) -> None:
    """The latest version of every key as one batch of ``into``, numbered like the last batch it holds."""
    last = spark.read.parquet(path).agg(F.max("batch")).first()[0]  # one number
    latest(spark, path, keys).write.mode("overwrite").parquet(f"{into}/batch={last}")
