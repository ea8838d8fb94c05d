"""The registered queries of this subpackage: one opN_<name> for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import caps, chat, decontam, langid, mixing, quality, sharding, simhash, suffix, toxicity
from .common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_near_duplicates(table(spark, sf_dir, "documents")).selectExpr("id AS doc_id", "`group` AS group_id", "keep", "class AS class_id", "links AS n_links")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_spans(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.detect(docs, langid.fit(docs)).withColumnRenamed("id", "doc_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"), {"toxicity": "toxic"}, severe="severe")
    return toxicity.score(docs, chain).withColumnRenamed("id", "doc_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.group_near_vectors(table(spark, sf_dir, "embeddings")).selectExpr("id AS vec_id", "`group` AS group_id", "keep", "class AS class_id", "links AS n_links")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_language_id": op3_language_id,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
}

_OP2 = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
), place AS (
  SELECT doc_id, unnest(range(len(w) - 49)) AS pos, w FROM split
), win AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos + 1 : pos + 50], ' ')) AS k FROM place
), marked AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS r FROM win
), island AS (
  SELECT *, CASE WHEN pos < lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS new FROM marked WHERE n > 1
), numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM island
)
SELECT doc_id, CAST(min(pos) AS BIGINT) AS start_token, CAST(max(pos) + 50 AS BIGINT) AS end_token, count(*) AS n_windows, count(*) FILTER (r = 1) AS n_first
FROM numbered GROUP BY doc_id, span
"""

_OP5 = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t
), stated AS (
  SELECT *, CASE WHEN before IS NULL AND place = 0 THEN 'start' WHEN before = 'system' THEN 'system' WHEN before = 'assistant' THEN 'answered'
                 WHEN before = 'user' AND place > 2 THEN 'again' WHEN before = 'user' AND place = 2 AND first_value(role) OVER (PARTITION BY conv_id ORDER BY place) = 'user' THEN 'again'
                 ELSE 'asked' END AS state FROM placed
), judged AS (
  SELECT *, NOT coalesce((state = 'start' AND role IN ('system', 'user')) OR (state = 'system' AND role = 'user')
                         OR (state IN ('asked', 'again') AND role = 'assistant') OR (state = 'answered' AND role = 'user'), false) AS bad FROM stated
), conv AS (
  SELECT conv_id, bool_or(turn IS NULL) AS unnumbered, count(DISTINCT turn) < count(*) AS twice, min(place) FILTER (bad) AS fault_at, arg_max(role, place) AS final, bool_or(role = 'assistant') AS answered
  FROM judged GROUP BY conv_id
), fault AS (
  SELECT c.conv_id, CASE WHEN unnumbered THEN 'a turn without a number' WHEN twice THEN 'two turns of one number'
    WHEN fault_at IS NOT NULL THEN 'turn ' || fault_at || ': ' || coalesce(j.role, 'no role') || ' after ' || j.state
    WHEN final = 'system' THEN 'ends after system' WHEN final = 'user' AND NOT answered THEN 'ends after asked' END AS error
  FROM conv c LEFT JOIN judged j ON j.conv_id = c.conv_id AND j.place = c.fault_at
), piece AS (
  SELECT p.conv_id, p.place, s.k, p.role, s.text, s.loss FROM placed p JOIN fault f ON f.conv_id = p.conv_id AND f.error IS NULL,
  LATERAL (SELECT 0 AS k, CASE p.role WHEN 'assistant' THEN '<|assistant|>' || chr(10) ELSE '<|' || p.role || '|>' || chr(10) || coalesce(p.text, '') || '<|end|>' || chr(10) END AS text, false AS loss
           UNION ALL SELECT 1, coalesce(p.text, '') || '<|end|>' || chr(10), true WHERE p.role = 'assistant') s
)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY place, k) - 1 AS INTEGER) AS segment, role, text, loss, CAST(NULL AS VARCHAR) AS error FROM piece
UNION ALL SELECT conv_id, NULL, NULL, NULL, NULL, error FROM fault WHERE error IS NOT NULL
"""

ORACLES: dict[str, str] = {
    "op2_suffix_array_dedup": _OP2,
    "op5_chat_formatting": _OP5,
}
