"""All registered queries."""

from tallyfold.queries import changes, cycles, documents, reads, rules  # noqa: F401
from tallyfold.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
