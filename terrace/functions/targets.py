"""Targets: the one of the row's year, and whether a value meets it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.numbers import finite

# The four states of a target.
MET = "Atingida"
BELOW = "Abaixo"
NO_TARGET = "Sem meta"
NO_DATA = "Sem dado"
STATUS_ORDER = (MET, BELOW, NO_TARGET, NO_DATA)


def yearly_columns(columns: Iterable[str], prefix: str) -> dict[int, str]:
    """Columns named ``<prefix><year>``, by year."""
    found = {c[len(prefix):]: c for c in columns if c.startswith(prefix)}
    return {int(tail): found[tail] for tail in sorted(found) if tail.isdigit()}


def target_of_year(columns: Iterable[str], prefix: str, year: Column) -> Column:
    """Value of the yearly column that belongs to ``year``; null when there is none."""
    by_year = yearly_columns(columns, prefix)
    if not by_year:
        return F.lit(None).cast("double")
    return F.coalesce(*[F.when(year == y, F.col(c)) for y, c in by_year.items()])


def target_status(value: Column, target: Column) -> Column:
    """Whether the value meets the target; what is no finite number is no value, or no target."""
    value, target = finite(value), finite(target)
    return (
        F.when(target.isNull(), NO_TARGET)
        .when(value.isNull(), NO_DATA)
        .when(value >= target, MET)
        .otherwise(BELOW)
    )


def gap_to_target(value: Column, target: Column) -> Column:
    """Percentage points above (or, negative, below) the target; null if either is no finite number."""
    return finite(value) - finite(target)


def status_rank(status: Column) -> Column:
    """Position of a status in the display order, for sorting."""
    return F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), status)
