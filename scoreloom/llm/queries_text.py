"""Queries that judge each row by itself: main text (2), quality (3), language (4), decontamination (5), packing (7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import decontamination, html_text, language_id, packing, rule_ensemble
from scoreloom.llm.common import fold, held_out, table


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = rule_ensemble.fit(docs, labels.where(fold(labels.doc_id) != 0))
    scored = rule_ensemble.score(docs, model)
    return scored.select("doc_id", held_out(scored.doc_id).alias("held_out"), "score", "predicted")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(docs.doc_id) != 0))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(found.doc_id).alias("held_out"), "lang_pred", "score")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return hit.selectExpr(
        "doc_id", "n_words", "n_hit", "bigint(size(items)) AS n_items", "sha2(array_join(items, ','), 256) AS items_sha256",
        f"{decontamination.IS_CONTAMINATED} AS contaminated",
    )


SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL_CONTAMINATION = f"""
  d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {SQL_WORDS} AS w FROM {{docs}}),
  b AS MATERIALIZED (SELECT item_id, least(len(w), 13) AS n, w FROM (SELECT item_id, {SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
  bw AS MATERIALIZED (SELECT DISTINCT item_id, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS win
    FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
  dw AS MATERIALIZED (SELECT rid, i, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS win
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
  hits AS MATERIALIZED (SELECT DISTINCT rid, i, n, win FROM dw WHERE win IN (SELECT win FROM bw)),
  words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
  items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits JOIN bw USING (win)) GROUP BY rid)"""

ORACLE_OP5 = f"""
WITH {SQL_CONTAMINATION.format(docs='documents')}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a token is the smallest segment, so as many segments as tokens are no limit
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.Limits(segments=packing.Limits.tokens))


QUERIES = {
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_language_id": op4_language_id,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op7_packing": op7_packing,
}
ORACLES = {"op5_benchmark_decontamination": ORACLE_OP5}
