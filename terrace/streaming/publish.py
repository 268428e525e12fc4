"""Publication of rows as record files that can be taken up where it stopped.

Rows are dealt into ranges by a hash of their key. A range is committed as a whole, in a
directory of its own, and then noted with the number and a checksum of its rows. A later
call computes these figures for the rows it is given, without encoding any, and publishes
the ranges that are not noted with them. Equal rows fall into one range, so all of them are
published, and published records are never read or compared.

Between the commit of a range and its note a failure can leave a range that is whole but
not noted; its directory is then written again, in place of what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.layers import read_if_present
from terrace.streaming.records import to_records

RANGES, RANGES_A_COMMIT = 16, 4
#: Below the published files; Spark's readers pass over names with an underscore in front.
NOTE = "_progress"

_FIGURES = "range int, rows bigint, checksum decimal(38,0)"


def range_of(df: DataFrame, key: str, ranges: int):
    """The range of a row: by its key, all rows without one in the same."""
    value = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    return F.pmod(F.xxhash64(value), F.lit(ranges)).cast("int")


def range_figures(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """``range``, ``rows`` and ``checksum`` of the rows; the sum of row hashes knows repeats."""
    own = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.groupBy(range_of(df, key, ranges).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(own).alias("checksum")
    )


def published_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The note: the ranges that were committed, as last written."""
    noted = read_if_present(spark, f"{path}/{NOTE}")
    if noted is None:
        return spark.createDataFrame([], _FIGURES)
    last = F.max_by(F.struct("rows", "checksum"), "noted").alias("f")
    return noted.groupBy("range").agg(last).select("range", "f.rows", "f.checksum")


def publish(
    df: DataFrame,
    key: str,
    path: str,
    records_per_file: int = 1_000_000,
    ranges: int = RANGES,
    ranges_a_commit: int = RANGES_A_COMMIT,
) -> list[int]:
    """Write the rows as record files, each one bounded batch of a replay; the ranges written.

    The source is scanned once for the figures and once for each ``ranges_a_commit`` ranges
    that are left. The number of ranges belongs to the path: another one than noted fails.
    """
    spark = df.sparkSession
    figures = range_figures(df, key, ranges)
    noted = published_ranges(spark, path)
    if not noted.filter(F.col("range") >= ranges).isEmpty():
        raise ValueError(f"{path} was published with more than {ranges} ranges")
    # A row a range at most.
    left = figures.join(noted, ["range", "rows", "checksum"], "left_anti").sort("range").collect()
    done = []
    for at in range(0, len(left), ranges_a_commit):
        part = left[at : at + ranges_a_commit]
        own = range_of(df, key, ranges)
        rows = df.filter(own.isin([r["range"] for r in part]))
        # The range is computed from the record's own columns, next to the payload.
        records = to_records(rows.withColumn("_range", range_of(rows, key, ranges)), key, omit=("_range",))
        # Small ranges get a file or so, large ones are split; else every task had a file in each.
        dealt = records.withColumnRenamed("_range", "range").hint("rebalance", F.col("range"))
        (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", records_per_file)
            .partitionBy("range").parquet(path)
        )
        note = spark.createDataFrame([tuple(r) for r in part], _FIGURES)
        note.withColumn("noted", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/{NOTE}")
        done += [r["range"] for r in part]
    return done
