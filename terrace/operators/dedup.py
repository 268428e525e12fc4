"""One row per business key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """Keep, per key, the row that is greatest by ``latest_by`` and then by all other columns.

    The order is total up to rows that are equal, so the survivor never depends on row
    order. It is an aggregate, not a window: every task first reduces its own rows to
    one per key, so a key with a third of all rows costs the shuffle one row per task.

    ``copies`` names a column for the number of rows the key had. Keys that the table
    lacks are ignored, with none left the table is returned as it is. Rows with a null in
    the key are nobody's copies: they are not in the result but in ``without_key``.
    """
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.withColumn(copies, F.lit(1).cast("bigint")) if copies else df
    df = df.filter(~lacks_key(df, keys))
    first = [c for c in latest_by if c in df.columns and c not in present]
    order = first + [c for c in df.columns if c not in present and c not in first]
    aggregates = [F.count(F.lit(1)).alias("_copies")]
    if order:
        aggregates.append(F.max(F.struct(*order)).alias("_kept"))
    reduced = df.groupBy(*present).agg(*aggregates)
    kept = [F.col(c) if c in present else F.col(f"_kept.{c}").alias(c) for c in df.columns]
    return reduced.select(*kept, *([F.col("_copies").alias(copies)] if copies else []))


def lacks_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """True for a row with a null in one of the keys that the table has."""
    lacking = F.lit(False)
    for key in keys:
        if key in df.columns:
            lacking = lacking | F.col(key).isNull()
    return lacking


def without_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that deduplication leaves aside, as they are."""
    return df.filter(lacks_key(df, keys))


def dedup_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, after and removed by deduplication, and those without a key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    whole, zero = ~lacks_key(per_key, keys), F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("copies"), zero).alias("rows_before"),
        F.count_if(whole).alias("rows_after"),
        F.coalesce(F.sum(F.when(whole, F.col("copies") - 1)), zero).alias("rows_removed"),
        F.coalesce(F.sum(F.when(~whole, F.col("copies"))), zero).alias("rows_without_key"),
    )
