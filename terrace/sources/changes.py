"""Which partitions of a table are not as they were when they were last used.

A partition is known by its files: how many they are, their bytes, and a checksum of their
paths, sizes and times. No file is opened. What was last used is noted per table, one row a
partition, and a note is replaced only when the work that used the partition is done; after
a failure the same partitions count as changed again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.layers import read_if_present

#: Stands for files that are in no partition of the column.
WHOLE = ""
_FIGURES = "partition string, files bigint, bytes bigint, checksum bigint"


def partition_files(spark: SparkSession, path: str, column: str, suffix: str = ".parquet") -> DataFrame:
    """``partition`` (the column's value in the path), ``files``, ``bytes`` and ``checksum``.

    The listing is Spark's, so it is spread over tasks where there are many directories.
    """
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{suffix}").load(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _FIGURES)
        raise
    value = F.regexp_extract("path", rf"/{column}=([^/]*)/", 1)
    return files.groupBy(value.alias("partition")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("checksum"),
    )


def noted(spark: SparkSession, path: str) -> DataFrame:
    """The last note of every partition."""
    found = read_if_present(spark, path)
    if found is None:
        return spark.createDataFrame([], _FIGURES)
    last = F.max_by(F.struct("files", "bytes", "checksum"), "written").alias("f")
    return found.groupBy("partition").agg(last).select("partition", "f.*").filter("files > 0")


def changed(figures: DataFrame, note: str) -> list[str]:
    """Partitions that are new or other than noted. A list of partitions, never of files."""
    before = noted(figures.sparkSession, note)
    return sorted(r[0] for r in figures.join(before, figures.columns, "left_anti").select("partition").collect())


def write_note(figures: DataFrame, note: str, partitions: Iterable[str]) -> None:
    """Note the partitions as used."""
    wanted = list(partitions)
    if wanted:
        rows = figures.filter(F.col("partition").isin(wanted))
        rows.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").parquet(note)
