"""CSV under a contract: the header must match, rows that do not parse are set aside."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the file, with the raw line of the malformed ones in ``_corrupt_record``.

    A renamed, missing or reordered header column fails the job instead of shifting
    values silently; an empty field is null. Every row is parsed in full, also when a
    query needs few columns, since a row is malformed because of any of its fields.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("sep", ",")
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )
    # The reader converts only the fields a query asks for. Counting the nulls asks for all.
    nulls = reduce(add, [F.col(name).isNull().cast("int") for name in schema.fieldNames()])
    return rows.withColumn(CORRUPT, F.when(nulls >= 0, F.col(CORRUPT)))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNotNull())


def file_path() -> Column:
    """Path of the file a row was read from."""
    return F.col("_metadata.file_path")


def entity_of_path(path: Column, prefix: str, extension: str = ".csv") -> Column:
    """Entity name from a file path: directory, ``prefix`` and ``extension`` taken off."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, re.escape(extension) + "$", "")
    return F.regexp_replace(stem, "^" + re.escape(prefix), "")
