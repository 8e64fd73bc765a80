"""Operator 1, SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

Fingerprints are grouped to distinct values, distinct values are cut into tiles by
population count, and only tile pairs whose counts differ by at most the radius are
compared (two values at distance d differ in population count by at most d, so the skip
loses nothing).  A tile pair is one numpy exclusive-or and bit count over its block; it
emits a spanning forest of its links, at most one row per fingerprint, never the pairs.
Work is quadratic in the number of *distinct* fingerprints by definition of the method;
shuffled data is one copy of a tile per partner tile.

Nulls, ties and odd input: a null or empty text has fingerprint 0 and links like any other;
rows with equal texts (or repeated rows) share a fingerprint and so a component; a null
doc_id is kept, never names a component, and takes its class's smallest id; an empty table
gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import components, documents, min_label, raw, stored, text_slices

SHINGLE, RADIUS, SEED = 4, 4, 42
#: distinct fingerprints per tile: at least / at most
TILE_MIN, TILE_MAX = 4096, 131072
_ROWS = 128  # block height inside a tile pair: 128 x 16384 words stay in cache
_COLS = 16384


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles' XXH64; 0 for a text without words."""
    words = raw(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        cut = map(joined.__getitem__, map(slice, starts[at:at + (1 << 16)], ends[at:at + (1 << 16)]))
        digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, cut, repeat(SEED))), np.uint8)
        counts += np.unpackbits(digests).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, texts in text_slices(batches):
            fp = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            keys = [pa.array(cols[c], pa.string()) for c in cols if c == "copy_key"]
            yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(fp.view(np.int64)), *keys],
                                             ["doc_id", "fp", "copy_key"][:2 + len(keys)])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    return documents(docs).mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    """One row per tile: its fingerprints and their representatives, packed."""
    fp, rep = (np.ascontiguousarray(rows.column(c).to_numpy()) for c in ("fp", "rep"))
    return pa.table({"pop": [key[0].as_py()], "tile": [key[1].as_py()], "fps": [fp.tobytes()], "reps": [rep.tobytes()]},
                    pa.schema([("pop", pa.int32()), ("tile", pa.int32()), ("fps", pa.binary()), ("reps", pa.binary())]))


def links_in_block(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with at most ``radius`` differing bits, block by block."""
    for i in range(0, len(a), _ROWS):
        for j in range(0, len(b), _COLS):
            near = np.bitwise_count(a[i:i + _ROWS, None] ^ b[None, j:j + _COLS]) <= radius
            hits = np.flatnonzero(near)
            if len(hits):
                u, v = np.divmod(hits, near.shape[1])
                yield u + i, v + j


def _compare(radius: int):
    def run(rows: pa.Table) -> pa.Table:
        """Both tiles of a pair (or one tile with itself) to forest edges (node, root)."""
        fps = [np.frombuffer(x, np.uint64) for x in rows.column("fps").to_pylist()]
        reps = [np.frombuffer(x, np.int64) for x in rows.column("reps").to_pylist()]
        n = len(fps[0])
        node = np.concatenate(reps)
        order = np.argsort(node, kind="stable")  # labels are ranks by representative: the root is the smallest
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        label = np.arange(len(node))
        left, right = (fps[0], fps[-1])
        shift = n if len(fps) == 2 else 0
        for u, v in links_in_block(left, right, radius):
            min_label(label, rank[u], rank[v + shift])
        node = node[order]
        child = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": pa.array(node[child], pa.int64()), "b": pa.array(node[label[child]], pa.int64())})
    return run


def links(reps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Forest edges (a, b) between representatives of distinct fingerprints within ``radius`` bits.

    ``reps``: (fp, rep), one row per distinct fingerprint.
    """
    spark = reps.sparkSession
    popped = reps.where("rep is not null").withColumn("pop", F.bit_count("fp").cast("int"))
    sizes = {r["pop"]: r["n"] for r in popped.groupBy("pop").agg(F.count("*").alias("n")).collect()}  # 65 rows at most
    if not sizes:
        return spark.createDataFrame([], "a long, b long")
    per_tile = min(TILE_MAX, max(TILE_MIN, sum(sizes.values()) // 32))
    tiles = {p: -(-n // per_tile) for p, n in sizes.items()}
    count_of = F.create_map(*[F.lit(x) for p, n in sorted(tiles.items()) for x in (p, n)])
    packed = stored(popped.withColumn("tile", F.pmod(F.xxhash64("fp"), count_of[F.col("pop")]).cast("int"))
                    .groupBy("pop", "tile").applyInArrow(_tile, "pop int, tile int, fps binary, reps binary"), "tiles")
    # a tile's partners: tiles of population counts within the radius; the pair's key names the smaller tile first
    partner = (packed.withColumn("q", F.explode(F.sequence(F.col("pop") - radius, F.col("pop") + radius)))
               .withColumn("n", F.coalesce(count_of[F.col("q")], F.lit(0))).where("n > 0")
               .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("n") - 1))))
    mine, other = F.struct("pop", "tile"), F.struct(F.col("q").alias("pop"), F.col("r").alias("tile"))
    paired = partner.select(F.least(mine, other).alias("lo"), F.greatest(mine, other).alias("hi"), "fps", "reps")
    pairs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (paired.repartition(pairs, "lo", "hi").groupBy("lo", "hi")
            .applyInArrow(_compare(radius), "a long, b long"))


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row.

    Components link fingerprints, not ids, so fingerprints whose rows all lack an id link and bridge like any other;
    a component without an id has the component_id null.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    reps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "reps")
    classes = components(links(reps.select("fp", F.col("fp").alias("rep")), radius), "a", "b")
    of_fp = stored(reps.join(classes, reps["fp"] == classes["node"], "left")
                   .select("fp", "first_id", F.coalesce("component", "fp").alias("component")), "fp-classes")
    ids = of_fp.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(of_fp.select("fp", "component").join(ids, "component").select("fp", "component_id"), "fp-ids")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The input rows without near copies: one row of each component stays.

    It is the row of the smallest doc_id (null after all others), then of the smallest digest of id and text,
    so repeated and null ids are settled like any other.  Components link fingerprints here, not ids.
    """
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("long").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    marked = (documents(docs).withColumn("copy_key", key)
              .mapInArrow(_fingerprints(shingle), "doc_id long, fp long, copy_key string"))
    rows = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "copy_key")
    firsts = stored(marked.groupBy("fp").agg(F.min(rows).alias("first")), "firsts")
    classes = components(links(firsts.select("fp", F.col("fp").alias("rep")), radius), "a", "b")
    keep = stored(firsts.join(classes, firsts["fp"] == classes["node"], "left")
                  .groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first"))
                  .select(F.col("first.copy_key").alias("_copy_key")), "kept")
    name = "_copy_key"
    while name in docs.columns:
        name = f"_{name}"
    once = docs.withColumn(name, key).dropDuplicates([name])  # combined per task: copies never meet in one
    return once.join(keep.withColumnRenamed("_copy_key", name), name, "left_semi").select(*docs.columns)
