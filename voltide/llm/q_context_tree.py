"""Language-model scores. SQL cannot state the model; tests compare it with a plain
version bit by bit, and its code length on held-out documents."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.context_tree import score_documents


@query("op2_context_tree")
def context_tree(spark, sf):
    return score_documents(table(spark, sf, "documents"))
