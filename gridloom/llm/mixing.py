"""Operator 4, mixing sources to target weights by systematic sampling (DataFrame operations only).

A source's target is its weight's share of the total, stopped at ``max_repeat`` times the
source's size with the excess reshared by weight (water filling, solved in closed form over
the sources sorted by size per unit of weight).  Every document of a source expects
``target / source size`` copies; documents are ordered by (size, md5 of the id, id), the
expected copies are summed along that order from one pseudo-random offset per source, and a
document is taken once per integer boundary its own stretch of the sum crosses.  Ordering by size
spreads the copies evenly over short and long documents, so the taken words stay within
about one long document of the target.

The position of a document in its source is never a window over the source: counts per
(source, size) and per (source, size, leading md5 digits) give every cell its starting position
and ``row_number`` runs inside a cell, so a source or an exact copy that holds a third of all rows is
spread over 4,096 cells.  ``copies`` shuffles only (id, source, size) rows, ``mix`` each row once.

Nulls, ties and odd input: a null text has size 0 and a null source is a source of its own, last;
documents of size 0 and sources without words are taken 0 words (such a source's target is 0);
equal (size, id) rows are interchangeable; a null doc_id sorts as the empty text; an empty
table gives no rows; further columns, whatever their names, stay out of ``copies`` and pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import stored, word_count

WEIGHTS, SHARE, MAX_REPEAT, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, "0"


def _source_key(source: str = "source") -> Column:
    """Non-null text that sorts like the source by code point, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(skey, source_size, target, rate, start) per source of ``sized`` (skey, size); rows = number of sources."""
    by_key = Window.orderBy("skey")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("no") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = (sized.groupBy("skey").agg(F.sum("size").alias("source_size"))
           .withColumn("no", F.row_number().over(by_key)).withColumn("w", weight)
           .withColumn("cap", max_repeat * F.col("source_size")).withColumn("level", F.col("cap") / F.col("w")))
    every = Window.partitionBy()
    along = Window.orderBy("level", "skey")
    per = (per.withColumn("total", share * F.sum("source_size").over(every))
           .withColumn("cap_before", F.sum("cap").over(along) - F.col("cap"))
           .withColumn("w_from", F.sum("w").over(every) - F.sum("w").over(along) + F.col("w"))
           # a source is stopped when its cap lies under the level that the rest would share
           .withColumn("shared", (F.col("total") - F.col("cap_before")) / F.col("w_from"))
           .withColumn("free", F.col("level") > F.col("shared"))
           .withColumn("water", F.min(F.when(F.col("free"), F.struct("level", "skey", "shared"))).over(every)["shared"]))
    target = F.when(F.col("free"), F.col("water") * F.col("w")).otherwise(F.col("cap"))
    per = per.withColumn("target", F.least(F.col("cap"), target))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + "|"), "skey")), 1, 12), 16, 10).cast("double") / float(16 ** 12)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("skey", "source_size", "target", rate.alias("rate"), offset.alias("start"))


def _placed(rows: DataFrame, weights, share: float, max_repeat: float) -> DataFrame:
    """``rows`` (doc_id, skey, size, digest, ...) with source_size, target and copies."""
    rows = rows.withColumn("cell", F.substring("digest", 1, 3))
    cells = rows.groupBy("skey", "size", "cell").agg(F.count("*").alias("n"))
    sizes = cells.groupBy("skey", "size").agg(F.sum("n").alias("n_size"))  # distinct sizes: bounded by the longest text
    per_source = targets(sizes.select("skey", (F.col("size") * F.col("n_size")).alias("size")), weights, share, max_repeat)
    sizes = (sizes.withColumn("before_size", F.sum("n_size").over(Window.partitionBy("skey").orderBy("size")) - F.col("n_size"))
             .join(per_source, "skey").drop("n_size"))
    cells = (cells.withColumn("before", F.sum("n").over(Window.partitionBy("skey", "size").orderBy("cell")) - F.col("n"))
             .join(sizes, ["skey", "size"])
             .select("skey", "size", "cell", (F.col("before") + F.col("before_size")).alias("before"),
                     "source_size", "target", "rate", "start"))
    in_cell = F.row_number().over(Window.partitionBy("skey", "size", "cell").orderBy("digest", "doc_id"))
    upto = F.col("before") + F.col("place")
    crossed = (F.floor(F.col("start") + F.col("rate") * upto) - F.floor(F.col("start") + F.col("rate") * (upto - 1)))
    n = F.least(F.greatest(crossed, F.floor("rate")), F.ceil("rate"))  # rounding can't move it past the neighbours
    return (rows.withColumn("place", in_cell).join(cells, ["skey", "size", "cell"])
            .withColumn("copies", F.when(F.col("size") > 0, n).otherwise(F.lit(0)).cast("long")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _source_key().alias("skey"), word_count("text").alias("size"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("digest"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies (how often the mix takes it)."""
    rows = stored(_keyed(docs).drop("row"), "mix-sizes")
    return _placed(rows, weights, share, max_repeat).select("doc_id", "size", "source_size", "target", "copies")


def taken(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, size, source_size, target and the words the mix takes of the document."""
    return copies(docs, **kw).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as the mix takes it."""
    return (_placed(_keyed(docs), weights, share, max_repeat).where("copies > 0")
            .select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*"))
