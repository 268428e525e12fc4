"""Comparisons between rows of small, already aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def change_from_previous_year(
    df: DataFrame, keys: Sequence[str], year: str, value: str, change: str
) -> DataFrame:
    """Add ``change``: the value minus that of exactly one year before, null if there is none.

    ``df`` has one row per key and year. Every row also acts as the previous year of the
    following one, and the two meet in one aggregate. The table is read once and no
    row is mistaken for last year's when a year is missing.
    """
    payload = [c for c in df.columns if c not in keys and c != year]
    now = F.struct(
        F.col(year).alias("y"),
        F.struct(*payload).alias("own"),
        F.lit(None).cast(df.schema[value].dataType).alias("before"),
    )
    later = F.struct(
        (F.col(year) + 1).cast(df.schema[year].dataType).alias("y"),
        F.lit(None).alias("own"),
        F.col(value).alias("before"),
    )
    met = (
        df.select(*keys, F.explode(F.array(now, later)).alias("r"))
        .groupBy(*keys, F.col("r.y").alias(year))
        .agg(F.max("r.own").alias("own"), F.max("r.before").alias("before"))
        .filter(F.col("own").isNotNull())
    )
    return met.select(
        *[F.col(c) if c in keys or c == year else F.col(f"own.{c}").alias(c) for c in df.columns],
        (F.col(f"own.{value}") - F.col("before")).alias(change),
    )


def share_of_group(df: DataFrame, group: Sequence[str], count: str, share: str) -> DataFrame:
    """Add each row's percentage of its group's total; rows are kept."""
    total = F.sum(count).over(Window.partitionBy(*group))
    return df.withColumn(share, F.col(count) / total * 100)
