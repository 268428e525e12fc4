"""Distinct counts of any slice from sketches that merge, and samples by stratum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the sketches' buckets: 4096 buckets, a standard error of 1.6 %.
BUCKET_BITS = 12
STANDARD_ERROR = 1.04 / 2 ** (BUCKET_BITS / 2)


def distinct_sketches(table: DataFrame, dimensions: Sequence[str], counted: str) -> DataFrame:
    """A sketch of the values of ``counted`` for every combination of the dimensions.

    To be stored next to the table: a slice of any width is answered from these few rows.
    """
    return table.groupBy(*dimensions).agg(F.hll_sketch_agg(counted, BUCKET_BITS).alias("sketch"))


def distinct_of_slices(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimates of distinct values for each of ``by``, from the sketches that belong to it."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    return sketches.groupBy(*by).agg(estimate) if by else sketches.agg(estimate)


def within_error(estimate: Column, exact: Column, errors: float = 4.0) -> Column:
    """Whether an estimate is as near the exact count as its error allows."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(errors * STANDARD_ERROR))


def stratified_sample(
    table: DataFrame, strata: Sequence[str], ids: Sequence[str], per_stratum: int
) -> DataFrame:
    """From each stratum the ``per_stratum`` rows whose ids have the lowest hashes, or all if fewer.

    Adds ``stratum_rows``, how many the stratum has, so that a row's weight is known. The
    hash is fixed, so the sample is the same whatever the partitioning; a task passes on
    no more than that many rows of a stratum, and no row is sorted against all others.
    """
    order = [F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ids])), *[F.col(c) for c in ids]]
    first = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    kept = table.withColumn("_place", first).filter(F.col("_place") <= per_stratum).drop("_place")
    sizes = table.groupBy(*strata).agg(F.count(F.lit(1)).alias("stratum_rows"))
    same = [kept[c].eqNullSafe(sizes[c]) for c in strata]
    joined = kept.join(sizes, same, "left")
    return joined.select(*[kept[c] for c in kept.columns], "stratum_rows")
