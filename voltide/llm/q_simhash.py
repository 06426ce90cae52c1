"""SimHash query. SQL has no XXH64; tests compare it with all pairs of a small table."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.simhash import near_duplicates


@query("op8_simhash_pivots")
def simhash_pivots(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))
