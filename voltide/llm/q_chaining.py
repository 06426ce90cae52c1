"""Repeated passages. SQL cannot chain and align; tests compare with plain versions."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.chaining import passages
from voltide.llm.common import table


@query("op3_collinear_chaining")
def collinear_chaining(spark, sf):
    return passages(table(spark, sf, "documents")).drop("text_key")
