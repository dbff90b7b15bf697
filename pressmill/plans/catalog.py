"""All queries: importing a module registers its queries."""

from pressmill.plans import (  # noqa: F401
    io_queries, model_queries, pipeline_queries, profile_queries, split_queries, stem_queries,
    text_queries,
)
from pressmill.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
