"""All registered queries: importing a module registers its queries."""

from voltide.plans import (  # noqa: F401
    q_cells,
    q_clean,
    q_evaluate,
    q_features,
    q_models,
    q_monitor,
    q_privacy,
    q_select,
    q_sources,
    q_stream,
    q_windows,
)
from voltide.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
