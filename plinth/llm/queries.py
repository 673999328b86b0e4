"""Queries opN_<name>: each applies one operator to its whole table. SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import table
from plinth.llm.conflict_packing import pack_documents
from plinth.llm.exact_dedup import exact_dedup
from plinth.llm.html_text import extract_text
from plinth.llm.language_id import language_id
from plinth.llm.mixing import mix_sources
from plinth.llm.near_dedup import near_dedup
from plinth.llm.nearest import nearest
from plinth.llm.pii import find_pii
from plinth.llm.quality import quality
from plinth.llm.token_packing import pack_tokens


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_nearest": op2_nearest,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_token_packing": op5_token_packing,
    "op6_html_text": op6_html_text,
    "op7_near_dedup": op7_near_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_conflict_packing": op9_conflict_packing,
    "op10_language_id": op10_language_id,
}

ORACLES: dict[str, str] = {
    "op1_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid
  FROM d GROUP BY source
), w AS (SELECT *, [5.0, 2.0, 1.0][(sid - 1) % 3 + 1]::DOUBLE AS weight FROM s
), l AS (
  SELECT *, row_number() OVER up AS place,
    (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER
      (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW up AS (ORDER BY source_size / weight, sid)
), c AS (SELECT level AS common FROM l WHERE level * weight <= 2.0::DOUBLE * source_size ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size,
         coalesce(least(2.0::DOUBLE * source_size, (SELECT common FROM c) * weight), 2.0::DOUBLE * source_size) AS target
  FROM l
), p AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS words,
         (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  (words // source_size) * size + greatest(0, least(start + size, words % source_size) - start) END::BIGINT AS taken
FROM p
""",
    "op8_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents
), g AS (SELECT n, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(n) AS text_sha256
FROM t JOIN g USING (n)
""",
}
