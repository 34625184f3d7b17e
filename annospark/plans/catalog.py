"""All queries of the library outside the training-data operators, and the same in SQL."""

from . import annotation_queries, step_queries, traffic_queries  # noqa: F401  (register themselves)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
