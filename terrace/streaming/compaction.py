"""Compaction of a stream's batch directories into files of a target size.

Consecutive batches of a run are packed into bins by the size of their files. A bin is
written next to the batches, under names that readers of batches pass over, and becomes
valid by a line in a manifest. From that moment readers take the bin and leave its batches
out, before it they do the opposite, so no reader sees a row twice or misses one. The
batches' files are emptied later, by :func:`sweep`, when no older reader is left.

A run that was ended between the two writes leaves a bin without a line; the next call
writes it again in its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.sources.layers import read_if_present

MANIFEST, BINS = "_manifest", "_bins"
TARGET_BYTES = 256 << 20
LAYOUT = ("run", "batch_id")


def _listed(spark: SparkSession, out: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", "*.parquet").load(out).select("path", "length")


def stored_files(spark: SparkSession, out: str) -> int:
    """How many files hold rows, of batches and of bins."""
    own = _listed(spark, out).filter(~F.col("path").contains(f"/{MANIFEST}/"))
    bins = _listed(spark, f"{out}/{BINS}") if manifest(spark, out) is not None else None
    return own.count() + (bins.count() if bins is not None else 0)


def batch_files(spark: SparkSession, out: str) -> DataFrame:
    """``run``, ``batch_id``, ``files`` and ``bytes`` of every batch directory; nothing is opened."""
    listed = _listed(spark, out)
    batch = F.regexp_extract("path", r"/run=([^/]+)/batch_id=([0-9]+)/", 2)
    run = F.regexp_extract("path", r"/run=([^/]+)/batch_id=([0-9]+)/", 1)
    own = listed.filter(~F.col("path").contains(f"/{BINS}/") & ~F.col("path").contains(f"/{MANIFEST}/"))
    return (
        own.select(run.alias("run"), batch.try_cast("bigint").alias("batch_id"), "length")
        .filter("run <> '' AND batch_id IS NOT NULL")
        .groupBy("run", "batch_id").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def manifest(spark: SparkSession, out: str) -> DataFrame | None:
    """``bin``, ``run``, ``first`` and ``last`` (batch) of every valid bin."""
    found = read_if_present(spark, f"{out}/{MANIFEST}")
    return None if found is None else found.select("bin", "run", "first", "last").distinct()


def plan_bins(
    spark: SparkSession, out: str, target_bytes: int = TARGET_BYTES, keep_last: int = 1
) -> DataFrame:
    """``bin``, ``run``, ``first`` and ``last`` of the bins to write: two batches or more each.

    Batches in a valid bin and the last ``keep_last`` of each run, which may yet run again,
    are left alone. Windows are over batches, of which there are few, never over rows.
    """
    batches = batch_files(spark, out)
    done = manifest(spark, out)
    if done is not None:
        inside = (batches["run"] == done["run"]) & F.col("batch_id").between(done["first"], done["last"])
        batches = batches.join(done, inside, "left_anti")
    in_run = Window.partitionBy("run").orderBy("batch_id")
    from_end = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("batch_id")))
    before = F.coalesce(F.sum("bytes").over(in_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        batches.withColumn("from_end", from_end).filter(F.col("from_end") > keep_last)
        .withColumn("place", F.floor(before / target_bytes))
        .groupBy("run", "place").agg(
            F.min("batch_id").alias("first"), F.max("batch_id").alias("last"), F.sum("files").alias("files")
        )
        .filter("first < last")
        .select(F.format_string("%s.%d.%d", "run", "first", "last").alias("bin"), "run", "first", "last", "files")
    )


def _inside(rows: list, of: tuple[str, str] = LAYOUT) -> Column:
    """True for the batches of these bins, each a range of batch numbers of a run."""
    run, batch = (F.col(c) for c in of)
    each = [(run == r["run"]) & batch.between(r["first"], r["last"]) for r in rows]
    return reduce(Column.__or__, each, F.lit(False))


def compact_batches(
    spark: SparkSession,
    out: str,
    partition_by: str = "ano",
    target_bytes: int = TARGET_BYTES,
    keep_last: int = 1,
) -> list[str]:
    """Write the bins that are due, all in one job, and make them valid; their names.

    The rebalance hint gives a small partition of a bin one file and splits a large one. A
    bin has the batches' columns and is partitioned like them.
    """
    bins = plan_bins(spark, out, target_bytes, keep_last).collect()  # a row a bin
    if not bins:
        return []
    rows = spark.read.parquet(out)
    name = F.coalesce(*[F.when(_inside([b]), b["bin"]) for b in bins])
    parts = ["bin", "record_status", partition_by]
    packed = rows.filter(_inside(bins)).withColumn("bin", name).hint("rebalance", *[F.col(c) for c in parts])
    packed = packed.withColumnsRenamed({"run": "of_run", "batch_id": "of_batch"})
    (
        packed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(f"{out}/{BINS}")
    )
    lines = spark.createDataFrame(
        [(b["bin"], b["run"], b["first"], b["last"]) for b in bins],
        "bin string, run string, first bigint, last bigint",
    )
    lines.coalesce(1).write.mode("append").parquet(f"{out}/{MANIFEST}")
    return [b["bin"] for b in bins]


def read_batches(spark: SparkSession, out: str) -> DataFrame | None:
    """All rows that were ingested, once each: of valid bins, and of the batches in none."""
    batches = read_if_present(spark, out)
    done = manifest(spark, out)
    if done is None:
        return batches
    lines = done.collect()  # a row a bin
    bins = spark.read.parquet(f"{out}/{BINS}").filter(F.col("bin").isin([r["bin"] for r in lines]))
    bins = bins.drop("bin").withColumnsRenamed({"of_run": "run", "of_batch": "batch_id"})
    if batches is None:
        return bins
    rest = batches.filter(~_inside(lines))
    return bins.select(*[F.col(c).cast(t).alias(c) for c, t in rest.dtypes]).unionByName(rest)


def sweep(spark: SparkSession, out: str) -> int:
    """Empty the directories of batches that are in valid bins; how many had files.

    To be called when no reader that began before the last compaction is left. An empty
    directory stays for each batch, so that its number is not mistaken for a new one.
    """
    done = manifest(spark, out)
    if done is None:
        return 0
    batches = batch_files(spark, out)
    inside = (batches["run"] == done["run"]) & F.col("batch_id").between(done["first"], done["last"])
    swept = batches.join(done, inside, "left_semi").collect()  # a row a batch
    nothing = spark.createDataFrame([], "record_status string, ano int, nothing string")
    for batch in swept:
        where = f"{out}/run={batch['run']}/batch_id={batch['batch_id']}"
        nothing.write.mode("overwrite").partitionBy("record_status", "ano").parquet(where)
    return len(swept)
