"""Joins that add columns and never rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.contracts import Dimension


def add_dimension(
    df: DataFrame, dimension: Dimension | None, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Left join with the dimension of the contract; nothing to do without one or its key."""
    if dimension is None or dimension.key not in df.columns:
        return df
    return df.join(tables[dimension.name], on=dimension.key, how="left")


def with_unique_key(
    base: DataFrame, right: DataFrame, keys: Sequence[str], what: str
) -> DataFrame:
    """The same base rows, but the query fails if ``right`` repeats a key.

    The test is a scalar subquery over the small right side, so it runs with the query
    and not as a job of its own. It leaves both inputs of the join as they are: the
    planner still sees the size of the right table, and a hot key of the base can be
    split by the adaptive skew join, which an aggregate below the join would prevent.
    Keys with a null never join and are not tested.
    """
    repeated = (
        right.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > 1)
        .agg(F.max(F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])).alias("_key"))
    )
    message = F.concat(
        F.lit(f"{what} has several rows for {', '.join(keys)} = "), F.col("_key")
    )
    unique = repeated.select(
        F.when(F.col("_key").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    )
    return base.filter(unique.scalar())


def add_columns(
    base: DataFrame, right: DataFrame | None, keys: Sequence[str], what: str
) -> DataFrame:
    """Left join on equal column names with a checked right side; absent right side, no join."""
    if right is None:
        return base
    return with_unique_key(base, right, keys, what).join(right, on=list(keys), how="left")


def join_coverage(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: fact rows, rows with a match, rows without, and distinct unmatched keys.

    The fact is reduced to one row per key before it meets the dimension, so a hot key
    is one row in the join.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    marked = per_key.join(
        dimension.select(key).distinct().withColumn("_matched", F.lit(True)), on=key, how="left"
    )
    orphan = F.col("_matched").isNull()
    return marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(~orphan, F.col("n"))), F.lit(0)).alias("matched_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact keys that the dimension does not have, with their number of rows."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return per_key.join(dimension.select(key).distinct(), on=key, how="left_anti")
