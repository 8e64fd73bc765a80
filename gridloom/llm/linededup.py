r"""Operator 12, line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble.

A line's key is the line without the six ASCII white-space bytes at both ends and with A-Z
lower-cased.  Keys of at least ``least_chars`` code points that at least ``least_docs``
documents hold lose their lines everywhere but in the smallest doc_id.  A document is its
doc_id: rows that share an id count once, and each of them keeps its lines if the id is the
smallest.

Only 128-bit hashes of keys are exchanged.  Distinct (hash, document) pairs are counted per
hash behind a partial aggregate, so a line of a third of all rows reaches its reducer as one
row a task.  The way back joins every line with the shared hashes; a hash with more than
1/4096 of all (hash, document) pairs is salted in proportion (there are at most 4,096 of
them, the only table that is broadcast), so no task gets a hot line whole.  Dropped
positions are gathered per row, at most one per line of its text, and joined with the texts
by id and a hash of the text.

Nulls, ties and odd input: a null or empty text is one empty line and gives an empty text; a
null doc_id counts as one document after all others, so it loses every line that a named
document holds; repeated rows give equal results; a key whose only document is one id stays,
however often it repeats there; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import documents, raw, stored, text_slices

LEAST_CHARS, LEAST_DOCS = 10, 2
#: a hash with more than 1/HOT of all (hash, document) pairs is salted; so at most HOT hashes are
HOT = 4096
_BLANK = b" \t\n\v\f\r"


def line_key(line: bytes) -> bytes:
    """The line without outer white space, A-Z lower-cased (bytes.lower changes ASCII only)."""
    return line.strip(_BLANK).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _hash_lines(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, texts in text_slices(batches):
            row, pos, digests = [], [], []
            for i, text in enumerate(texts):
                for k, line in enumerate(raw(text).split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, least_chars):
                        row.append(i)
                        pos.append(k)
                        digests.append(xxhash.xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["doc_id"], pa.int64()).take(at), pa.array(cols["text_hash"], pa.int64()).take(at),
                 pa.array(pos, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                ["doc_id", "text_hash", "pos", "h1", "h2"])
    return run


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cols, texts in text_slices(batches):
        counts, gone, kept = [], [], []
        for text, dropped in zip(texts, cols["dropped"]):
            lines = raw(text).split(b"\n")
            counts.append(len(lines))
            gone.append(len(dropped) if dropped else 0)
            if dropped:
                out = set(dropped)
                lines = [x for k, x in enumerate(lines) if k not in out]
            kept.append(b"\n".join(lines).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols["doc_id"], pa.int64()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])


def drop_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every row with its shared lines dropped, one row per input row."""
    hashed = documents(docs).withColumn("text_hash", F.xxhash64("text"))
    lines = stored(hashed.mapInArrow(_hash_lines(least_chars), "doc_id long, text_hash long, pos int, h1 long, h2 long"),
                   "lines")
    holders = lines.select("h1", "h2", "doc_id").distinct()
    shared = stored(holders.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper"))
                    .where(F.col("n") >= least_docs), "shared-lines")
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]  # one number
    salted = shared.withColumn("salts", F.ceil(F.col("n") * HOT / F.lit(max(total, 1))).cast("int"))
    hot = salted.where("salts > 1").select("h1", "h2", "salts")
    keepers = salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts", "n")
    dealt = lines.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn(
        "salt", F.pmod(F.xxhash64("text_hash", "pos"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    dropped = (dealt.join(keepers, ["h1", "h2", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
               .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped")))
    d, t = dropped.alias("d"), hashed.alias("t")
    both = t.join(d, F.col("t.doc_id").eqNullSafe(F.col("d.doc_id")) & F.col("t.text_hash").eqNullSafe(F.col("d.text_hash")), "left")
    return (both.select("t.doc_id", "t.text", "d.dropped")
            .mapInArrow(_reassemble, "doc_id long, n_lines long, n_dropped long, text string"))


def digest(kept: DataFrame) -> DataFrame:
    """The contract's columns of ``drop_shared_lines``."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, row_no, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, s.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY row_no
"""
