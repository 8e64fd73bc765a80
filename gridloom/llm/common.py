"""Helpers shared by the training-data operators.

* ``stored`` writes a DataFrame as Parquet in the shared checkpoint folder and reads it
  back: a lineage cut that survives lost executors and is computed exactly once.
* ``text_slices`` walks Arrow batches in slices of bounded text size, ``text_ranges`` cuts a text column without leaving Arrow.
* ``min_label`` / ``components`` merge links: inside one task with numpy, and across the
  cluster with joins on a shrinking edge table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import scratch_path

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``; ``bytes.split()`` uses the same six bytes.
WORD_RE = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint directory and read it back."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw(text: str | None) -> bytes:
    """UTF-8 of a text, null read as empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = 4 << 20) -> Iterator[tuple[dict[str, list], list]]:
    """(other columns, texts) in slices of at most ``limit`` characters; a longer text is a slice alone."""
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names if n != text}
        texts = batch.column(text).to_pylist()
        start = size = 0
        for i, t in enumerate(texts):
            n = len(t) if t else 0
            if i > start and size + n > limit:
                yield {k: v[start:i] for k, v in cols.items()}, texts[start:i]
                start, size = i, 0
            size += n
        if texts:
            yield {k: v[start:] for k, v in cols.items()}, texts[start:]


def text_ranges(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text; a longer text is a range alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(sizes):
        yield start, len(sizes)


def held_out(doc_id: int | None, modulus: int) -> bool:
    """crc32 of the id's decimal text, remainder 1; a null id reads as the empty text."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus == 1


def min_label(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the links (u, v) into ``label`` (in place): every node ends at its class's smallest node."""
    while len(u):
        lu, lv = label[u], label[v]
        apart = lu != lv
        if not apart.any():
            return
        u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
        np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable over the links, for nodes that have a link.

    Every node hooks to its smallest smaller neighbour, chains are shortened by pointer
    jumping, and the edges are rewritten to the roots until none is left.  Each round is a
    partial aggregate and equi-joins of stored tables, so a hub's edges can be split by the
    skew join; edges inside a class vanish, so the table shrinks every round.
    """
    live = stored(edges.select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst"))
                  .where("src != dst").distinct(), "edges")
    labels = None
    while not live.isEmpty():
        hook = stored(live.groupBy("src").agg(F.min("dst").alias("dst")), "hook")
        while True:
            up = hook.select(F.col("src").alias("dst"), F.col("dst").alias("over"))
            jumped = stored(hook.join(up, "dst", "left").select("src", F.coalesce("over", "dst").alias("dst"),
                                                                F.col("over").isNotNull().alias("moved")), "jump")
            hook = jumped.select("src", "dst")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = hook
        else:
            up = hook.select(F.col("src").alias("dst"), F.col("dst").alias("over"))
            labels = stored(labels.join(up, "dst", "left").select("src", F.coalesce("over", "dst").alias("dst"))
                            .unionByName(hook), "labels")
        root = hook.withColumnRenamed("dst", "root")
        far = hook.select(F.col("src").alias("dst"), F.col("dst").alias("far"))
        live = stored(live.join(root, "src").join(far, "dst", "left")
                      .select(F.greatest("root", F.coalesce("far", "dst")).alias("src"),
                              F.least("root", F.coalesce("far", "dst")).alias("dst"))
                      .where("src != dst").distinct(), "edges")
    if labels is None:
        return live.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = labels.select(F.col("dst").alias("src"), "dst").distinct()
    return stored(labels.unionByName(roots), "classes").select(F.col("src").alias("node"), F.col("dst").alias("component"))


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long, text as string and the further columns named; all other columns are dropped."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(c) for c in more])


def word_count(text: str | Column) -> Column:
    """Number of words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
