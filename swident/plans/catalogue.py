"""All queries of the engine by name, and the SQL that checks them."""

from . import file_queries, match_queries, text_queries  # noqa: F401  they register themselves
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
