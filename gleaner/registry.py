"""All registered queries of the library proper: name -> function, name -> SQL."""

from __future__ import annotations

from gleaner.plans import changes, jobs, scored, searches  # noqa: F401  register their queries
from gleaner.plans.reports import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
