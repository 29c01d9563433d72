"""The registered queries: each operator over the given tables, with the SQL that states its result."""

from workload.registry import QUERIES, SQL
from workload import edges, feeds, health, merges, names, records, runs, trees  # noqa: F401

__all__ = ["QUERIES", "SQL"]
