"""URL query and its SQL.

The list: five rules, and as listed URLs the canonical URLs of the stated query set,
every page whose id is divisible by 20; all pages are judged against them.
"""

from __future__ import annotations

from voltide.llm import url_filter as u
from voltide.llm.catalog import query
from voltide.llm.common import table

RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]

_CASES = " UNION ALL ".join(f"SELECT '{r}' AS rule, '{v}' AS verdict" for v, r in RULES)
SQL = rf"""
WITH parsed AS (SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{u.UPPER}', '{u.LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    array_to_string(list_sort(list_filter(
      string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '{u.TRACKING}'))), '&') AS query
  FROM pages),
named AS (SELECT *, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical FROM parsed),
rules AS ({_CASES}),
fitting AS (SELECT p.r, rules.rule, rules.verdict,
    row_number() OVER (PARTITION BY p.r ORDER BY length(rules.rule) DESC) AS place
  FROM named p JOIN rules ON
    (p.host = string_split(rules.rule, '/')[1] OR ends_with(p.host, '.' || string_split(rules.rule, '/')[1]))
    AND starts_with(p.path, substr(rules.rule, strpos(rules.rule, '/')))),
listed AS (SELECT DISTINCT canonical FROM named WHERE page_id % 20 = 0 AND canonical IS NOT NULL)
SELECT p.page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named p LEFT JOIN (SELECT * FROM fitting WHERE place = 1) f ON p.r = f.r
LEFT JOIN listed l ON p.canonical = l.canonical
"""


@query("op4_url_bloom", SQL)
def url_bloom(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    listed = u.url_entries(pages.where("page_id % 20 = 0"))
    return u.judge_urls(pages, u.rule_entries(spark, RULES).unionByName(listed))
