"""Queries that compare documents with each other: suffix-array dedup (6) Jaccard join (8), nearest
neighbours (9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import jaccard, suffix_dedup, vector_search
from scoreloom.llm.common import table


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE_OP6 = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  w AS MATERIALIZED (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d)),
  f AS MATERIALIZED (SELECT s, min((doc_id, i)) AS first FROM w GROUP BY s HAVING count(*) > 1),
  dup AS MATERIALIZED (SELECT doc_id, i FROM w JOIN f USING (s) WHERE (doc_id, i) <> first),
  runs AS MATERIALIZED (SELECT doc_id, min(i) AS b, max(i) + 100 AS e FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k
    FROM (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS fresh FROM dup)) GROUP BY doc_id, k),
  gaps AS (SELECT doc_id, e AS a, coalesce(lead(b) OVER (PARTITION BY doc_id ORDER BY b), 1000000000) AS z FROM runs
    UNION ALL SELECT doc_id, 0, min(b) FROM runs GROUP BY doc_id),
  kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
  removed AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


SQL_COMPONENTS = r"""
  sw AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM {docs}),
  sh AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM sw WHERE len(w) > 0)),
  sn AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
  links AS MATERIALIZED (SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS o FROM sh p JOIN sh q ON p.s = q.s AND p.doc_id <> q.doc_id
    GROUP BY ALL) x JOIN sn m ON m.doc_id = x.a JOIN sn n ON n.doc_id = x.b WHERE 100 * x.o >= 85 * (m.n + n.n - x.o)),
  reach AS (SELECT doc_id, doc_id AS c FROM {docs} UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id),
  comp AS MATERIALIZED (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)"""

ORACLE_OP8 = f"""
WITH RECURSIVE {SQL_COMPONENTS.replace('{docs}', 'documents')}
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sn USING (doc_id) JOIN comp USING (doc_id)
"""

def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op6_suffix_dedup": op6_suffix_dedup, "op8_jaccard_join": op8_jaccard_join, "op9_nearest_neighbours": op9_nearest_neighbours}
ORACLES = {"op6_suffix_dedup": ORACLE_OP6, "op8_jaccard_join": ORACLE_OP8}
