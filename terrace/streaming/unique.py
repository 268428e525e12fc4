"""A running stream that stores each business key once, whatever is sent again.

The keys seen are state of the stream, kept in its checkpoint, so they are known after a
restart. A key is forgotten when the watermark, which follows the time at which records
arrive, is further than ``within`` past the record that brought it: state grows with the
keys of that time, not with the table. What comes again later is stored again and removed
by the deduplication of the conformed layer, as are copies across two checkpoints.

At scale the state belongs on disk: set ``spark.sql.streaming.stateStore.providerClass``
to Spark's RocksDB provider before the stream starts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrace.contracts import PayloadSpec
from terrace.functions.lineage import Run
from terrace.operators.dedup import lacks_key
from terrace.streaming.ingest import PARTITIONS, ingest_status, record_reader, rows_writer
from terrace.streaming.records import RECORD_SCHEMA, VALID, parse_records

ARRIVED, PLACE = "_arrived", "_place"
#: Every batch loads and writes every partition of the state, so both are kept few.
BACKLOG_BATCHES, PARTITIONS_A_CORE = 8, 2


def arriving_records(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Record files as a stream, with the time each file arrived and each record's place.

    Batches are sized as those of :func:`terrace.streaming.ingest.file_records`.
    """
    reader = record_reader(spark, path, files_per_batch, BACKLOG_BATCHES)
    place = F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    return reader.parquet(path).select(
        *RECORD_SCHEMA.names,
        F.col("_metadata.file_modification_time").alias(ARRIVED),
        place.alias(PLACE),
    )


def unique_rows(
    records: DataFrame, spec: PayloadSpec, keys: Sequence[str], within: str = "7 days"
) -> DataFrame:
    """Parsed rows, of each key the first that arrives.

    Rejected records and rows with a null in the key are nobody's copies: their place
    makes each of them a key of its own, so all stay.
    """
    parsed = parse_records(records, spec, keep=(ARRIVED, PLACE))
    alone = (F.col("record_status") != VALID) | lacks_key(parsed, keys)
    marked = parsed.withColumn(PLACE, F.when(alone, F.col(PLACE)))
    return (
        marked.withWatermark(ARRIVED, within)
        .dropDuplicatesWithinWatermark([*keys, "record_status", PLACE])
        .drop(ARRIVED, PLACE)
    )


def unique_writer(
    spec: PayloadSpec,
    entity: str,
    out: str,
    label: str,
    clock: Callable[[], Run] = Run,
    compact: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The handler of a batch of :func:`unique_rows`; a repeated batch replaces itself.

    A batch is computed once, since each time it is the state is met and written again. Its
    rows are dealt anew, so that it leaves a file per core and year, not per state partition.
    """

    def dealt(batch: DataFrame) -> DataFrame:
        tasks = batch.sparkSession.sparkContext.defaultParallelism
        return batch.repartition(tasks, *spec.fields, "raw_record")

    return rows_writer(dealt, spec, entity, out, label, clock, compact, look_first=False)


def state_partitions(spark: SparkSession) -> int:
    """Partitions of the state of a new stream: those of the session's shuffles, or two a core.

    A partition costs each batch some file operations, whatever it holds, and a checkpoint
    keeps the number it began with.
    """
    cores = spark.sparkContext.defaultParallelism
    return min(int(spark.conf.get(PARTITIONS)), PARTITIONS_A_CORE * cores)


def unique_status(query: StreamingQuery) -> dict[str, object]:
    """State of the stream, the records it read and the copies it dropped lately, and the keys
    it remembers."""
    recent = query.recentProgress
    operators = [o for p in recent for o in p.stateOperators]
    return {
        **ingest_status(query),
        "records": sum(p.numInputRows for p in recent),
        "duplicates": sum(o.customMetrics.get("numDroppedDuplicateRows", 0) for o in operators),
        "keys_held": operators[-1].numRowsTotal if operators else 0,
    }
