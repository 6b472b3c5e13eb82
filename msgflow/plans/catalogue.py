"""All registered queries."""

from msgflow.plans import queries, stream_queries  # noqa: F401  (register on import)
from msgflow.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
