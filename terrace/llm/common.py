"""What several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.scratch import scratch_path

#: ASCII white space, as in the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read from there.

    Cuts lineage and keeps work from being done twice; lost executors lose none of it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one if the table has a column of that name, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text, fold 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def texts(column: pa.Array, rows: int = 512) -> Iterator[list[bytes | None]]:
    """The UTF-8 bytes of a string column, a few rows at a time."""
    for start in range(0, len(column), rows):
        yield column.slice(start, rows).cast(pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller record batches, so that working memory follows a few documents, not thousands."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Smaller record batches of at most so many bytes of text; a longer text is alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
        ends = np.cumsum(sizes, dtype=np.int64)
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])
