"""Quality query and its SQL."""

from __future__ import annotations

from voltide.llm import divergence as d
from voltide.llm.catalog import query
from voltide.llm.common import table


def _sql() -> str:
    spaces = r"[\x20\x09-\x0D]"
    words = d.common_words()
    counted = ", ".join(
        f"CAST(length(t) - length(regexp_replace(t, '{p.replace(chr(39), chr(39) * 2)}', '', 'g')) AS BIGINT) AS c_{c}"
        for c, p in d.CLASSES.items()
    )
    listed = ", ".join(f"'{w}'" for w in words)
    each = ", ".join(f"len(list_filter(common, lambda x: x = '{w}')) AS {d.word_name(w)}" for w in words)
    shares = ", ".join(f"c_{c} / CAST(greatest(chars, 1) AS DOUBLE) AS p_{c}" for c in d.CLASSES)
    rest = " - ".join(f"p_{c}" for c in [*d.CLASSES, "space"])
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{spaces}+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
      FROM d),
windows AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k
            FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, sum(least(8, coalesce(after - i, 8))) AS n
            FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM twice) GROUP BY r),
counted AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(t) AS chars,
              CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
              CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, {counted},
              list_filter(ws, lambda x: x IN ({listed})) AS common FROM w),
shares AS (SELECT *, {shares}, (chars - word_chars) / CAST(greatest(chars, 1) AS DOUBLE) AS p_space,
             CAST(greatest(n_words, 1) AS DOUBLE) AS words, {each} FROM counted),
lettered AS (SELECT *, 1 - ({rest.replace(' - ', ' + ')}) AS p_letter FROM shares),
judged AS (SELECT r, doc_id, n_words, word_chars, c_symbol AS n_symbols, n_dup_lines,
             {d.character_distance_sql()} AS character_distance,
             {d.word_distance_sql()} AS word_distance FROM lettered),
based AS (SELECT j.*, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
            n_words < {d.BASE_WORDS} OR 100 * coalesce(c.n, 0) > 30 * n_words AS base_failed
          FROM judged j LEFT JOIN covered c ON j.r = c.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({d.verdict_sql()}) AS kept FROM based
"""


@query("op5_distribution_divergence", _sql())
def distribution_divergence(spark, sf):
    return d.judge_documents(table(spark, sf, "documents")).select("doc_id", *d.BASE)
