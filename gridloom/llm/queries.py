"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import (convrepair, divergence, embeddup, katz, langid, linededup, mixing, packing, piiboost, preference,
                          simhash, tokenfile, wordruns)
from gridloom.sources.tables import read_table


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, d: str) -> DataFrame:
    """Operator 1: every document with its fingerprint and near-copy component."""
    return simhash.dedup(read_table(spark, d, "documents"))


def op2_langid(spark: SparkSession, d: str) -> DataFrame:
    """Operator 2: predicted language of every document."""
    return langid.identify(read_table(spark, d, "documents"))


def op3_tokenfile(spark: SparkSession, d: str) -> DataFrame:
    """Operator 3: every document's place, length and checksum, read back from the written files."""
    return tokenfile.digest(tokenfile.write_tokens(read_table(spark, d, "documents"), vocabulary(tokenfile.VOCABULARY)))


def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Operator 4: words the mix takes of every document."""
    return mixing.taken(read_table(spark, d, "documents"))


def op5_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Operator 5: links, component and verdict of every vector."""
    return embeddup.dedup(read_table(spark, d, "embeddings"))


def op6_preference(spark: SparkSession, d: str) -> DataFrame:
    """Operator 6: prompt and masked completions of every conversation against a branch of it with another answer."""
    return preference.format_pairs(preference.branched_pairs(read_table(spark, d, "conversations")))


def op7_packing(spark: SparkSession, d: str) -> DataFrame:
    """Operator 7: place of every piece of every document in the packed sequences."""
    return packing.pack(read_table(spark, d, "documents"), vocabulary(packing.VOCABULARY))


def op8_divergence(spark: SparkSession, d: str) -> DataFrame:
    """Operator 8: base features, divergence and verdict of every document."""
    return divergence.rate(read_table(spark, d, "documents"))


def op9_katz(spark: SparkSession, d: str) -> DataFrame:
    """Operator 9: unigram and Katz scores of every document."""
    return katz.score(read_table(spark, d, "documents"))


def op10_pii(spark: SparkSession, d: str) -> DataFrame:
    """Operator 10: personal data of every document."""
    return piiboost.search(read_table(spark, d, "documents"))


def op11_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    """Operator 11: faults, cheapest edits and repaired text of every conversation after it is damaged."""
    return convrepair.digest(read_table(spark, d, "conversations"))


def op12_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Operator 12: lines of every document, before and after shared lines are dropped."""
    return linededup.digest(linededup.drop_shared_lines(read_table(spark, d, "documents")))


def op13_word_runs(spark: SparkSession, d: str) -> DataFrame:
    """Operator 13: runs of every document, some of them given repeats, and its words without the repeats."""
    return wordruns.digest(wordruns.find_runs(wordruns.with_repeats(read_table(spark, d, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash, op2_langid, op3_tokenfile, op4_mixing, op5_embedding_dedup, op6_preference, op7_packing, op8_divergence, op9_katz, op10_pii,
        op11_conversation_repair, op12_line_dedup, op13_word_runs)}

#: Spark and DuckDB share md5, so systematic sampling is the same arithmetic in both.
MIXING_SQL = """
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
s AS (
  SELECT skey, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY skey) AS no FROM d GROUP BY skey),
w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((no - 1) % 3 + 1)::INT] AS w, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (
  SELECT *, cap / w AS level, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS w_all FROM w),
f AS (
  SELECT *, (total - (sum(cap) OVER o - cap)) / (w_all - sum(w) OVER o + w) AS shared FROM l WINDOW o AS (ORDER BY level, skey)),
g AS (
  SELECT *, arg_min(shared, (level, skey)) FILTER (WHERE level > shared) OVER () AS water FROM f),
t AS (
  SELECT skey, source_size, least(cap, CASE WHEN level > shared THEN water * w ELSE cap END) AS target,
         ('0x' || substr(md5('0|' || skey), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS start FROM g),
r AS (
  SELECT d.*, source_size, target, start, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         (row_number() OVER (PARTITION BY skey ORDER BY size, digest, doc_id))::DOUBLE AS k FROM d JOIN t USING (skey))
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE size * least(greatest(floor(start + rate * k) - floor(start + rate * (k - 1)), floor(rate)), ceil(rate)) END::BIGINT AS taken
FROM r
"""

ORACLE: dict[str, str] = {"op4_mixing": MIXING_SQL, "op6_preference": preference.ORACLE_SQL,
                          "op11_conversation_repair": convrepair.ORACLE_SQL, "op12_line_dedup": linededup.ORACLE_SQL,
                          "op13_word_runs": wordruns.ORACLE_SQL}
