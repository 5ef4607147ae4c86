"""All registered queries."""

from __future__ import annotations

from ludolake.plans import (feature_queries, game_queries, governance_queries,  # noqa: F401
                            lake_queries, metric_queries, review_queries)
from ludolake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
