"""Layer tables: partitioned Parquet under a root, read back by layer and entity."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class MissingInput(RuntimeError):
    """A table that the next step cannot do without is not there."""


@dataclass(frozen=True)
class Store:
    """Where the layers live, on any file system Spark can reach."""

    spark: SparkSession
    root: str

    def path(self, layer: str, entity: str) -> str:
        return f"{self.root}/{layer}/{entity}"

    def read(self, layer: str, entity: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, entity))

    def read_if_present(self, layer: str, entity: str) -> DataFrame | None:
        return read_if_present(self.spark, self.path(layer, entity))

    def read_present(
        self, layer: str, entities: Iterable[str], required: Iterable[str] = ()
    ) -> dict[str, DataFrame]:
        """The tables that exist, by entity; fails before any work if a required one does not."""
        found = {e: self.read_if_present(layer, e) for e in entities}
        missing = [e for e in required if found.get(e) is None]
        if missing:
            raise MissingInput(f"{layer} tables missing: {', '.join(missing)}")
        return {e: df for e, df in found.items() if df is not None}


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or nothing where there is no directory or no file with rows in it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = ("ano",),
    compact: bool = False,
    replace_all: bool = False,
    watch: Sequence[Column] = (),
    hide: Sequence[str] = (),
) -> dict[str, object]:
    """Write a table and return what was written: rows, columns and the ``watch`` aggregates.

    Only the partitions present in ``df`` are replaced, unless ``replace_all``. A
    partition column the table lacks is ignored. The figures are observed by the write
    itself, in its last stage, so there is no separate counting job. Columns in
    ``hide`` may be used by ``watch`` and are not stored.

    ``compact`` groups the rows by partition before the write. The rebalance hint lets
    adaptive execution put a small partition into one file and split a large one, so
    no single task gets a whole hot partition.
    """
    partitions = [c for c in partition_by if c in df.columns]
    if compact:
        df = df.hint("rebalance", *[F.col(c) for c in partitions])
    observation = Observation()
    stored = df.observe(observation, F.count(F.lit(1)).alias("rows"), *watch).drop(*hide)
    writer = stored.write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if replace_all else "dynamic"
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    return {"rows": 0, **observation.get, "columns": len(stored.columns)}


def export_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with a header; every task writes its own part."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
