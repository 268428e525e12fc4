"""All queries of the library, and the SQL that says what each must return."""

from __future__ import annotations

from terrace.plans import catalogue, oracle, upkeep

QUERIES = {**catalogue.QUERIES, **upkeep.QUERIES}
ORACLE = {**oracle.ORACLE, **upkeep.ORACLE}
