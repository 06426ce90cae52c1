"""Embedding query and its SQL."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.tree_forest import LEAST_COSINE, near_vectors

SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {LEAST_COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, root.component_id,
  e.vec_id = root.component_id AS kept
FROM embeddings e JOIN root ON e.vec_id = root.a LEFT JOIN n ON e.vec_id = n.a
"""


@query("op1_projection_forest", SQL)
def projection_forest(spark, sf):
    return near_vectors(table(spark, sf, "embeddings"))
