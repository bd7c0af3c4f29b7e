"""Queries over the given tables, each with its SQL twin where one exists."""

from wagegrid.plans import (  # noqa: F401  (modules register their queries)
    cleaning_queries,
    feature_queries,
    load_queries,
    model_queries,
    page_queries,
    stat_queries,
    term_queries,
)
from wagegrid.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
