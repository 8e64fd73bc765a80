"""Operator 5, embedding near-dedup: random-hyperplane signs in several tables, exact cosine, components.

Equal vectors are reduced to one representative with a count first (a partial aggregate, so a
vector that fills a third of the table costs one row).  Each representative gets one code per
table, the signs of its products with ``bits`` seeded random hyperplanes.  Vectors that share
a code in a table are compared by exact cosine in double precision.  Buckets of any size are
cut into tiles of ``TILE`` vectors and compared tile against tile, so none is capped and none is one
task.  A pair that meets in several tables is counted in the first only (the codes of both are at
hand).  A tile pair returns one row per vector, its partial link count and its root in the tile's
spanning forest, never the pairs.

``bits`` follows the number of representatives (about ``PER_BUCKET`` per bucket) and the number of tables
follows from it: two vectors at the threshold agree in one sign with probability 1 - angle / pi,
so tables are added until such a pair is missed with probability at most ``MISS``.

Nulls, ties and odd input: null, empty and zero vectors and vectors with null or non-finite components link with
nothing (0 links, a component of their own); vectors of different lengths never link; equal
vectors, repeated rows included, link with each other and are counted one by one; a null vec_id
is linked and counted but names no component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import components, min_label, stored

THRESHOLD, MISS, PER_BUCKET, TILE, SEED = 0.9, 0.001, 256, 2048, 5
_SLAB = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, safe against overflow."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def plan(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = max(4, min(30, math.ceil(math.log2(max(2, n / PER_BUCKET)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _codes(bits: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            vec = batch.column("vec").to_pylist()
            codes: list = [None] * len(vec)
            for d in np.unique(dim):
                d = int(d)
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).normal(size=(d, bits * tables))
                of = np.flatnonzero(dim == d)
                x = np.frombuffer(b"".join(vec[i] for i in of), np.float64).reshape(len(of), d)
                signs = (unit(x) @ planes[d] >= 0).reshape(len(of), tables, bits)
                c = (signs << np.arange(bits)).sum(2).astype(np.int32)
                for i, row in zip(of, c):
                    codes[i] = row.tolist()
            keep = [n for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(codes, pa.list_(pa.int32()))], [*keep, "codes"])
    return run


def _join_tiles(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        """All vectors of one tile pair (or of one tile) -> (rep, links, root) of those that link here."""
        side = rows.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        rows = rows.take(pa.array(order))
        side = side[order]
        table, dim = int(rows.column("t")[0].as_py()), int(rows.column("dim")[0].as_py())
        rep, weight = (rows.column(c).to_numpy().astype(np.int64) for c in ("rep", "n"))
        v = unit(np.frombuffer(b"".join(rows.column("vec").to_pylist()), np.float64).reshape(len(rep), dim))
        codes = np.array(rows.column("codes").to_pylist(), np.int32).reshape(len(rep), -1)[:, :table]
        split = int(np.searchsorted(side, 1)) if side.max() == 1 else 0
        links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        rank = np.argsort(np.argsort(rep, kind="stable"), kind="stable")
        right = np.arange(split, len(rep)) if split else np.arange(len(rep))
        for lo in range(0, split or len(rep), _SLAB):
            left = np.arange(lo, min(lo + _SLAB, split or len(rep)))
            a, b = np.nonzero(v[left] @ v[right].T >= threshold)
            a, b = left[a], right[b]
            if not split:
                a, b = a[a < b], b[a < b]
            for at in range(0, len(a), 1 << 16):
                i, j = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
                new = ~(codes[i] == codes[j]).any(1)
                i, j = i[new], j[new]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                min_label(label, rank[i], rank[j])
        by_rank = np.argsort(rank, kind="stable")
        root = rep[by_rank[label[rank]]]
        on = links > 0
        return pa.table({"rep": pa.array(rep[on]), "links": pa.array(links[on]), "root": pa.array(root[on])})
    return run


def dedup(embeddings: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    spark = embeddings.sparkSession
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = (F.size("embedding") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.col("embedding"))
            .withColumn("good", F.coalesce(good, F.lit(False))))
    # little-endian doubles of the vector; zeros lose their sign so that equal vectors have equal bytes
    packed = rows.mapInArrow(_pack, "vec_id long, dim int, vec binary")
    packed = stored(packed.withColumn("key", F.sha2("vec", 256)), "vectors")
    mine = packed.where("vec is not null")
    reps = stored(mine.groupBy("key", "dim").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("vec").alias("vec")), "reps")
    # representatives are numbered by their vec_id; one whose rows all lack an id takes a negative hash
    reps = reps.withColumn("rep", F.coalesce("first", -F.pmod(F.xxhash64("key"), F.lit(1 << 62)) - 1))
    n = reps.count()
    bits, tables = plan(n, threshold, miss)
    coded = stored(reps.select("rep", "n", "dim", "vec").mapInArrow(_codes(bits, tables, seed), "rep long, n long, dim int, vec binary, codes array<int>"), "codes")
    placed = coded.select("*", F.posexplode("codes").alias("t", "code"))
    sizes = (coded.select("dim", F.posexplode("codes").alias("t", "code")).groupBy("dim", "t", "code").agg(F.count("*").alias("m"))
             .where("m > 1").withColumn("tiles", F.ceil(F.col("m") / TILE).cast("int")).drop("m"))
    mates = (placed.join(sizes, ["dim", "t", "code"]).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("rep", "n", "dim", "vec", "codes", "t", "code", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                     (F.col("mine") > F.col("other")).cast("int").alias("side")))
    found = stored(mates.groupBy("dim", "t", "code", "lo", "hi").applyInArrow(_join_tiles(threshold), "rep long, links long, root long"), "tile-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.where("rep != root").select("rep", "root"), "rep", "root")
    # a class's name: the smallest real vec_id in it
    named = (reps.select("key", "n", "rep", "first").join(links, "rep", "left")
             .join(classes.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    named = stored(named, "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_key = stored(named.join(smallest, "component").select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "classes-by-key")
    component = F.coalesce("component_id", "vec_id")
    return packed.join(of_key, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = batch.column("good").to_pylist()
        dim, vec = [], []
        for ok, x in zip(good, batch.column("v")):
            x = (x.values.to_numpy(zero_copy_only=False) + 0.0) if ok else None
            dim.append(len(x) if ok else 0)
            vec.append(x.astype("<f8").tobytes() if ok else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(dim, pa.int32()), pa.array(vec, pa.binary())], ["vec_id", "dim", "vec"])
