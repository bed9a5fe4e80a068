"""The operators as named queries over the test tables, with SQL equivalents."""

from daybook.queries.oracle import ORACLE_SQL
from daybook.queries.registry import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
