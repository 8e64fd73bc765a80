"""Corpus pipeline: quality rules, near copies, personal data, source mix, packed sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import divergence, mixing, packing, piiboost, simhash
from gridloom.llm.common import stored
from gridloom.llm.queries import vocabulary
from gridloom.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 8)."""
    return divergence.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 1)."""
    return simhash.keep_first(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind (operator 10); n_chars follows the new text."""
    redacted = piiboost.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them (operator 4)."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in the packed sequences (operator 7)."""
    return packing.pack(docs, vocabulary(packing.VOCABULARY))


STAGES = [("quality_rules", quality), ("simhash_dedup", near_copies), ("pii", private), ("mixing", mixture), ("packing", packed)]

#: the stages run trained models and a tokenizer, which SQL can't express; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored in the shared folder before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
