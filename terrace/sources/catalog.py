"""Layer tables as named tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def register(spark: SparkSession, database: str, layer: str, entity: str, path: str) -> str:
    """Register an external table ``<layer>_<entity>`` over the files and find its partitions.

    A table that is already there is registered anew, since its columns may have changed;
    the files stay as they are. One that is not external is an error: its files are its own.
    """
    name = f"{layer}_{entity}"
    full = quoted(database, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    if spark.catalog.tableExists(full):
        kind = spark.catalog.getTable(full).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{database}.{name} is not external but {kind}, left as it is")
        spark.sql(f"DROP TABLE {full}")
    spark.catalog.createTable(full, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(full)):
        spark.catalog.recoverPartitions(full)
    return full


def column_names(spark: SparkSession, table: str) -> list[str]:
    """Columns of a registered table, in order, partition columns last."""
    return [c.name for c in spark.catalog.listColumns(table)]


def has_columns(df: DataFrame, *names: str) -> bool:
    """Whether an optional part of a report can be built from this table."""
    return set(names) <= set(df.columns)
