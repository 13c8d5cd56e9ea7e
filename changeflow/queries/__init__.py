"""All registered queries."""

from changeflow.queries import changes, lineage, records, replays, runs, trees  # noqa: F401
from changeflow.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
