"""All queries of the subpackage: importing a module registers its queries."""

from voltide.llm import (  # noqa: F401
    q_chaining,
    q_context_tree,
    q_divergence,
    q_language,
    q_page_text,
    q_simhash,
    q_source_audit,
    q_tokens,
    q_tree_forest,
    q_url_filter,
    q_whitening,
)
from voltide.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
