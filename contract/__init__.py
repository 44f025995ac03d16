"""Queries and SQL behind the driver contract."""

from contract import (  # noqa: F401
    feature_queries,
    flow_queries,
    grid_queries,
    learn_queries,
    profile_queries,
    quality_queries,
    source_queries,
    time_queries,
)
from contract.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
