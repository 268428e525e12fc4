"""Tables stored in sorted buckets of their key, so that work by that key moves no rows.

A bucket is one file, written by one task that has all rows of its keys in order. Grouping
such a table by its key, or joining two of the same number of buckets, needs neither an
exchange nor, with :func:`ordered_buckets`, a sort.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.dedup import deduplicate

#: Lets a scan of one file a bucket keep the order that its rows were written in.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def bucketed_name(label: str, database: str = "default") -> str:
    """A table name nobody else uses."""
    return f"{database}.{label}_{uuid.uuid4().hex}"


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Store the rows as the external table ``name``, in sorted buckets of the key.

    The number of buckets is part of the layout: tables that are to be joined need the same
    one. Choose it so that a bucket fits a task, some hundred megabytes.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def ordered_buckets(spark: SparkSession) -> Iterator[None]:
    """Plans made within take the order of buckets as given."""
    before = spark.conf.get(ORDERED, "false")
    spark.conf.set(ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED, before)


def merge_bucketed(
    stored: DataFrame, new: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()
) -> DataFrame:
    """One row a key of both tables: the greatest by ``latest_by``, then by all other columns.

    ``stored`` has each key once, in buckets, and stays where it is; only ``new`` is reduced
    to a row a key and dealt to the buckets. Rows of ``new`` with a null in the key are left
    out, as :func:`deduplicate` does.
    """
    first = [c for c in latest_by if c in stored.columns and c not in keys]
    order = first + [c for c in stored.columns if c not in keys and c not in first]
    if not order:
        raise ValueError("nothing but the key is stored")
    packed = F.struct(*order)
    old = stored.select(*keys, packed.alias("_old"))
    come = deduplicate(new.select(*stored.columns), keys, latest_by).select(*keys, packed.alias("_new"))
    kept = F.greatest("_old", "_new").alias("_kept")  # of one side only, that one
    met = old.join(come, list(keys), "full").select(*keys, kept)
    return met.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in stored.columns])
