"""All queries of the library by name, and SQL that returns the same rows."""

from __future__ import annotations

from fissure.plans import groups, more, rows  # noqa: F401  they register their queries
from fissure.plans.bridge import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
