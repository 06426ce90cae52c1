"""Page text query. SQL cannot parse HTML; tests compare it with hand-made pages."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.page_text import extract_text


@query("op10_host_suffix_array")
def host_suffix_array(spark, sf):
    return extract_text(table(spark, sf, "pages"))
