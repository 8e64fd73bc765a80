r"""Operator 6, chat formatting of preference pairs.

A pair is two conversations, chosen and rejected.  Their longest common prefix of turns (same
role and text) is rendered once as the prompt; the turns after it are the two completions, each
with a loss mask: the spans (code points in the completion, end exclusive) of assistant texts with
their end marker.  Turn texts are rendered as ``<|role|>\n text <|end|>\n``.

The prefix is found by joining the two sides turn by turn and taking the first position that
differs (a partial aggregate per pair), so no conversation is compared in one task; rendering
gathers one conversation per row, which is its output size.

Nulls, ties and odd input: a null role is rendered as ``none`` and a null text as empty, both compare equal to
themselves only (null with null); turns with equal numbers are ordered by role, then text, nulls first; a
repeated row is a turn of its own; a null turn number comes first; rows with a null conversation id belong to no pair; a pair with
one side only has an empty prompt and an empty other side; a side that is a prefix of the other has
an empty completion; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def rendered(role: str | Column, text: str | Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("none")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def pair_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (pair_id, chosen, turn, role, text) -> with ``pos``, the turn's place in its conversation."""
    order = Window.partitionBy("pair_id", "chosen").orderBy("turn", "role", "text")
    return turns.withColumn("pos", F.row_number().over(order))


def format_pairs(turns: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask: one row per pair.

    ``turns``: (pair_id, chosen boolean, turn, role, text), one row per turn.
    """
    placed = pair_turns(turns.select("pair_id", "chosen", F.col("turn").cast("long").alias("turn"),
                                     F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")))
    # one row per pair and position: equal when both sides have the turn and it is the same
    same = (F.count("*") == 2) & F.min("role").eqNullSafe(F.max("role")) & F.min("text").eqNullSafe(F.max("text"))
    same = same & F.count("role").isin(0, 2) & F.count("text").isin(0, 2)
    first_change = (placed.groupBy("pair_id", "pos").agg(same.alias("same"))
                    .groupBy("pair_id").agg(F.min(F.when(~F.col("same"), F.col("pos"))).alias("change"), F.max("pos").alias("last"))
                    .select("pair_id", (F.coalesce("change", F.col("last") + 1) - 1).alias("n_prompt_turns")))
    parts = placed.join(first_change, "pair_id")
    # the prompt is taken from the chosen side; a pair with a prompt has both
    parts = parts.where("chosen or pos > n_prompt_turns").withColumn("part", F.when(F.col("pos") <= F.col("n_prompt_turns"), "prompt")
                                                                    .when(F.col("chosen"), "chosen").otherwise("rejected"))
    one = F.struct("pos", rendered("role", "text").alias("out"), F.coalesce("role", F.lit("none")).alias("role"))

    def turns_of(part: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("part") == part, one)))

    gathered = parts.groupBy("pair_id", "n_prompt_turns").agg(*[turns_of(p).alias(p) for p in ("prompt", "chosen", "rejected")])

    def text_of(part: str) -> Column:
        return F.array_join(F.transform(part, lambda x: x["out"]), "")

    def mask_of(part: str) -> Column:
        """Spans of trained turns: from behind the role line to behind the end marker."""
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            end = acc["at"] + F.length(x["out"])
            begin = acc["at"] + F.length(x["role"]) + 5
            span = F.concat(begin.cast("string"), F.lit(":"), (end - 1).cast("string"))
            return F.struct(end.alias("at"), F.when(x["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

        return F.array_join(F.aggregate(part, start, step, lambda acc: acc["spans"]), ",")

    return gathered.select("pair_id", "n_prompt_turns", text_of("prompt").alias("prompt"),
                           text_of("chosen").alias("chosen"), mask_of("chosen").alias("chosen_mask"),
                           text_of("rejected").alias("rejected"), mask_of("rejected").alias("rejected_mask"))


def branched_pairs(conversations: DataFrame) -> DataFrame:
    """The query's input, pairs of a table without preferences: one per conversation.

    Chosen is the conversation.  Rejected are its turns before one of its assistant turns, picked by a hash, and then the
    first answer of the conversation next to it (2k and 2k + 1) as that turn; without an assistant turn it is empty,
    without an answer it ends there.  Rows without a conversation id belong to no pair.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).where("pair_id is not null")
    said = turns.where(F.col("role") == TRAINED_ROLE)
    hashed = F.md5(F.concat_ws(":", F.col("pair_id").cast("string"), F.col("turn").cast("string")))
    cuts = said.where("turn is not null").groupBy("pair_id").agg(F.min_by("turn", hashed).alias("cut"))
    answers = said.groupBy("pair_id").agg(F.min(F.struct("turn", "text")).alias("first"))
    answers = answers.select((F.col("pair_id") + 1 - 2 * F.pmod("pair_id", F.lit(2))).alias("pair_id"), F.col("first.text").alias("text"))
    before = turns.join(cuts, "pair_id").where("turn is null or turn < cut").drop("cut")
    answer = cuts.join(answers, "pair_id").select("pair_id", F.col("cut").alias("turn"), F.lit(TRAINED_ROLE).alias("role"), "text")
    return (turns.withColumn("chosen", F.lit(True))
            .unionByName(before.unionByName(answer).withColumn("chosen", F.lit(False))).select("pair_id", "chosen", "turn", "role", "text"))


ORACLE_SQL = """
WITH c AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
cut AS (
  SELECT pair_id, arg_min(turn, md5(pair_id || ':' || turn)) AS cut FROM c WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY pair_id),
answer AS (
  SELECT CASE WHEN pair_id % 2 = 0 THEN pair_id + 1 ELSE pair_id - 1 END AS pair_id, text FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, text NULLS FIRST) AS n FROM c WHERE role = 'assistant') WHERE n = 1),
sides AS (
  SELECT pair_id, true AS chosen, turn, role, text FROM c
  UNION ALL SELECT c.pair_id, false, turn, role, text FROM c JOIN cut ON cut.pair_id = c.pair_id WHERE turn IS NULL OR turn < cut
  UNION ALL SELECT cut.pair_id, false, cut, 'assistant', text FROM cut JOIN answer ON answer.pair_id = cut.pair_id),
t AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, chosen ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM sides),
same AS (
  SELECT pair_id, pos, count(*) = 2 AND min(role) IS NOT DISTINCT FROM max(role) AND min(text) IS NOT DISTINCT FROM max(text)
         AND count(role) IN (0, 2) AND count(text) IN (0, 2) AS same FROM t GROUP BY pair_id, pos),
lcp AS (
  SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT same), max(pos) + 1) - 1 AS n_prompt_turns FROM same GROUP BY pair_id),
r AS (
  SELECT t.pair_id, n_prompt_turns, chosen, pos, coalesce(role, 'none') AS role,
         '<|' || coalesce(role, 'none') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS out,
         pos <= n_prompt_turns AS in_prompt
  FROM t JOIN lcp USING (pair_id)),
e AS (
  SELECT *, sum(length(out)) OVER (PARTITION BY pair_id, chosen, in_prompt ORDER BY pos) AS upto FROM r)
SELECT pair_id, n_prompt_turns,
  coalesce(string_agg(out, '' ORDER BY pos) FILTER (WHERE in_prompt AND chosen), '') AS prompt,
  coalesce(string_agg(out, '' ORDER BY pos) FILTER (WHERE NOT in_prompt AND chosen), '') AS chosen,
  coalesce(string_agg((upto - length(out) + length(role) + 5)::BIGINT::VARCHAR || ':' || (upto - 1)::BIGINT::VARCHAR, ',' ORDER BY pos)
    FILTER (WHERE NOT in_prompt AND chosen AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(out, '' ORDER BY pos) FILTER (WHERE NOT in_prompt AND NOT chosen), '') AS rejected,
  coalesce(string_agg((upto - length(out) + length(role) + 5)::BIGINT::VARCHAR || ':' || (upto - 1)::BIGINT::VARCHAR, ',' ORDER BY pos)
    FILTER (WHERE NOT in_prompt AND NOT chosen AND role = 'assistant'), '') AS rejected_mask
FROM e GROUP BY pair_id, n_prompt_turns
"""
