"""Stream to raw layer, with a sink that a repeated batch cannot duplicate.

Progress is committed after a batch is written, so a crash in between runs the batch
again. Every batch therefore owns a directory, ``run=<label>/batch_id=<n>``, and
writing it replaces what an earlier attempt left there. The label belongs to a
checkpoint: batch numbers restart with a new checkpoint, which needs a new label.
Records read under two labels are told apart by the business key when the conformed
layer is built.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from terrace.contracts import PayloadSpec
from terrace.functions.lineage import Run, raw_lineage
from terrace.sources.layers import write_layer
from terrace.streaming.compaction import read_batches
from terrace.streaming.records import RECORD_SCHEMA, VALID, parse_records

LAYOUT = ("run", "batch_id", "record_status", "raw_record")
#: What a backlog is dealt into at most, since a batch costs the same however few its rows.
BACKLOG_BATCHES = 16
PARTITIONS = "spark.sql.shuffle.partitions"


def files_of_batch(
    spark: SparkSession, path: str, least: int, batches: int = BACKLOG_BATCHES
) -> int:
    """Files to a batch: ``least``, or the share of what lies there that makes ``batches`` of it.

    The state of a stream is met and directories are written once a batch by every task, so
    with batches of a fixed size both would grow with the table and its partitions alike.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(path).select("path").count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return least
        raise
    return max(least, -(-files // batches))


def record_reader(
    spark: SparkSession, path: str, files_per_batch: int | None, batches: int = BACKLOG_BATCHES
) -> DataStreamReader:
    """Reader of record files; a backlog of many files comes in larger batches than asked for."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if not files_per_batch:
        return reader
    return reader.option("maxFilesPerTrigger", files_of_batch(spark, path, files_per_batch, batches))


def file_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Published record files as a stream, from the first one on, in batches.

    A batch has ``files_per_batch`` files, or a share of a backlog (:func:`files_of_batch`).
    """
    reader = record_reader(spark, path, files_per_batch)
    return reader.parquet(path).select(*RECORD_SCHEMA.names)


def kafka_records(
    spark: SparkSession, servers: str, topic: str, records_per_batch: int | None = None
) -> DataFrame:
    """A topic as a stream, from the earliest record kept; needs the Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    return reader.load().select(F.col("key").cast("string"), F.col("value").alias("data"))


def batch_writer(
    spec: PayloadSpec,
    entity: str,
    out: str,
    label: str,
    clock: Callable[[], Run] = Run,
    compact: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The handler of one micro-batch; an empty batch writes nothing.

    Valid and rejected records go out in one pass, as partitions of the batch.
    ``compact`` shuffles the batch by partition first, for a stream of small batches
    that would otherwise leave a file per task and year; a backlog does without.
    """
    parse = lambda batch: parse_records(batch, spec)
    return rows_writer(parse, spec, entity, out, label, clock, compact)


def rows_writer(
    parse: Callable[[DataFrame], DataFrame],
    spec: PayloadSpec,
    entity: str,
    out: str,
    label: str,
    clock: Callable[[], Run] = Run,
    compact: bool = False,
    look_first: bool = True,
) -> Callable[[DataFrame, int], None]:
    """The handler of batches that ``parse`` turns into rows with a ``record_status``.

    Without ``look_first`` a batch is not asked first whether it is empty, so that it is
    computed once; an empty one then leaves a directory without files.
    """
    if not re.fullmatch(r"[A-Za-z][\w-]*", label):
        raise ValueError("a run label starts with a letter, so that it is read back as text")

    def write(batch: DataFrame, batch_id: int) -> None:
        if look_first and batch.isEmpty():
            return
        rows = raw_lineage(parse(batch), clock(), entity, f"stream:{entity}")
        write_layer(
            rows,
            f"{out}/run={label}/batch_id={batch_id}",
            partition_by=("record_status", spec.partition_by),
            compact=compact,
            replace_all=True,
        )

    return write


def start_ingest(
    records: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "30 seconds",
    partitions: int | None = None,
) -> StreamingQuery:
    """Start the stream: a batch at each interval, or with ``every=None`` all there is and stop.

    ``partitions`` are those of its shuffles and its state; a checkpoint keeps what it began with.
    """
    writer = records.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    conf = records.sparkSession.conf
    before = conf.get(PARTITIONS)
    try:  # the stream takes a copy of the session's settings when it starts
        conf.set(PARTITIONS, partitions or before)
        return writer.trigger(**trigger).start()
    finally:
        conf.set(PARTITIONS, before)


def drain(
    records: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    partitions: int | None = None,
) -> None:
    """Ingest what is available and return when it is written."""
    start_ingest(records, handler, checkpoint, None, partitions).awaitTermination()


def ingest_status(query: StreamingQuery) -> dict[str, object]:
    """Whether the stream runs, and how far it is."""
    last = query.lastProgress
    return {
        "active": query.isActive,
        "message": query.status["message"],
        "batch_id": last.batchId if last else None,
        "read_up_to": [source.endOffset for source in last.sources] if last else [],
    }


def stop_ingest(query: StreamingQuery) -> None:
    """Stop after the running batch; a later start goes on from the checkpoint."""
    if query.isActive:
        query.stop()


def read_ingested(spark: SparkSession, out: str) -> DataFrame | None:
    """Valid records of all runs, without the columns of the directory layout."""
    stored = read_batches(spark, out)
    if stored is None:
        return None
    return stored.filter(F.col("record_status") == VALID).drop(*LAYOUT)


def read_rejected(spark: SparkSession, out: str) -> DataFrame | None:
    """What was no record, as it came, with the run and batch it came in."""
    stored = read_batches(spark, out)
    if stored is None:
        return None
    return stored.filter(F.col("record_status") != VALID).select(
        "raw_record", "run", "batch_id", "_ingestion_timestamp"
    )
