"""Every registered query of the library, with its SQL where SQL can express it."""

from __future__ import annotations

from factloom.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
