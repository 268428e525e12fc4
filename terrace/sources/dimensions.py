"""Dimensions: trimmed text, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.contracts import Dimension


def read_dimension(spark: SparkSession, path: str, dimension: Dimension) -> DataFrame:
    raw = spark.read.option("header", True).option("sep", ",").csv(path)
    return conform_dimension(raw, dimension)


def conform_dimension(raw: DataFrame, dimension: Dimension) -> DataFrame:
    """Rename, trim, keep ids as text, and keep one row per key.

    Where a key has several rows the greatest one is kept as a whole, so the choice
    does not depend on the order in which rows arrive.
    """
    trimmed = raw.select(
        [F.trim(F.col(source).cast("string")).alias(name) for source, name in dimension.columns]
    )
    others = [name for _, name in dimension.columns if name != dimension.key]
    kept = trimmed.groupBy(dimension.key).agg(F.max(F.struct(*others)).alias("kept"))
    return kept.select(dimension.key, "kept.*").select([name for _, name in dimension.columns])
