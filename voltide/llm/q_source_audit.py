"""Source divergence query and its SQL."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.source_audit import LEAST_DOCUMENTS, SMOOTH, TERM_RANKS, UNIT, audit_sources

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
n AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY ALL),
gt AS (SELECT g.lang, g.source, v.v, v.total AS lang_total, coalesce(s.total, 0) AS total
  FROM g JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL) s USING (lang, source)),
p AS (SELECT gt.lang, gt.source, k.term, coalesce(n.n, 0) AS n,
    1 + CAST({UNIT}::HUGEINT * (coalesce(n.n, 0) + {SMOOTH}) // (gt.total + {SMOOTH} * gt.v) AS BIGINT) AS p,
    1 + CAST({UNIT}::HUGEINT * (k.lang_n + {SMOOTH}) // (gt.lang_total + {SMOOTH} * gt.v) AS BIGINT) AS q
  FROM gt JOIN kept k USING (lang) LEFT JOIN n ON n.lang = gt.lang AND n.source = gt.source AND n.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item,
    CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(far.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
term AS (SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM p WHERE n > 0 AND p > q),
parts AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' AS part FROM term),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""


@query("op13_source_audit", SQL)
def source_audit(spark, sf):
    return audit_sources(table(spark, sf, "documents"))
