"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame, with their
SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import (bpe_codec, hard_negatives, hash_tree, langid, packing, personal_data,
                          pivot_topk, ppm_score, rules, simhash, token_alignment, token_counts, url_filter)
from quaylake.llm.common import id_remainder, read_table

HELD_OUT_LANG = (4, 2)      # modulus, remainder
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_score.score(read_table(spark, sf_dir, "documents"),
                           id_remainder(F.col("doc_id"), 10) == 0, layout=True, words_before=2)


def op3_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


def op7_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.assign(read_table(spark, sf_dir, "documents"), 16)


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learned = rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return rules.judged(docs.select("doc_id", "text"), learned).select(
        "doc_id", *rules.COUNTS, "base_failed", "kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    modulus, remainder = HELD_OUT_LANG
    fold = id_remainder(F.col("doc_id"), modulus)
    model = langid.fit(docs.filter(fold != remainder))
    found = langid.identify(docs, model)
    return found.select("doc_id", (id_remainder(F.col("doc_id"), modulus) == remainder)
                        .alias("held_out"), "lang_pred", "score", "rejected")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(
        read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0,
        label=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.extract(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe_round_trip, op2_ppm_scores, op3_pivot_top_k, op4_simhash_groups, op5_token_counts,
        op6_harmonic_packing, op7_hash_tree_shards, op8_decision_list, op9_language_id, op10_url_filter,
        op11_token_alignment, op12_hard_negatives, op13_personal_data)}

#: The other operators' methods (hashes, tokenizers, learned models) have no SQL form; they are
#: tested against brute force, the tokenizer libraries and held-out texts.
ORACLE: dict[str, str] = {
    "op3_pivot_top_k": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.r <> q.r AND len(c.e) = len(q.e)
),
ranked AS (
  SELECT query_id, CAST(ROW_NUMBER() OVER (
           PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.r AS a_row, a.vec_id AS anchor_id, a.label = x.label AS same, x.vec_id,
         CAST(list_inner_product(a.e, x.e) AS BIGINT) AS score
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND x.r <> a.r AND len(a.e) = len(x.e)
),
positives AS (
  SELECT a_row, anchor_id, vec_id AS positive_id, score AS positive_score, place
  FROM (SELECT *, row_number() OVER (PARTITION BY a_row ORDER BY score DESC, vec_id) AS place
        FROM scored WHERE same)
  WHERE place <= 5
),
ranked AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score,
         n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.a_row, p.place ORDER BY n.score DESC, n.vec_id)
              AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.a_row = p.a_row AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5""",
}
