"""Jobs for ``spark-submit``: the layers, the stream, the checks and the catalog.

    spark-submit run.py layers --root <root> [--only bronze silver gold] [--replace-all]
    spark-submit run.py stream --root <root> --label <run label> --records <folder>
    spark-submit run.py stream --root <root> --label <run label> --kafka <servers> --topic <t>
    spark-submit run.py stream --root <root> --label <run label> --records <folder> --unique "7 days"
    spark-submit run.py refresh --root <root>
    spark-submit run.py compact --root <root> [--target-mb 256] [--sweep]
    spark-submit run.py checks --root <root>
    spark-submit run.py register --root <root> --database <prefix>
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from terrace.plans import literacy as L
from terrace.plans.layers import check_layers, register_layers, run_layers
from terrace.plans.refresh import refresh_layers
from terrace.sources.layers import Store, write_layer
from terrace.streaming.compaction import compact_batches, sweep
from terrace.streaming.ingest import batch_writer, file_records, kafka_records, start_ingest
from terrace.streaming.unique import arriving_records, state_partitions, unique_rows, unique_writer


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Jobs on the layered tables.")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the layers")
        return sub

    layers = job("layers", "build the layers in order")
    layers.add_argument(
        "--only", nargs="+", default=["bronze", "silver", "gold"],
        choices=["bronze", "silver", "gold"],
    )
    layers.add_argument("--replace-all", action="store_true", help="rewrite whole tables")

    stream = job("stream", "ingest student records")
    stream.add_argument("--label", required=True, help="name of this checkpoint's run")
    stream.add_argument("--records", help="folder of published record files")
    stream.add_argument("--files-per-batch", type=int)
    stream.add_argument("--kafka", help="bootstrap servers")
    stream.add_argument("--topic")
    stream.add_argument("--records-per-batch", type=int)
    stream.add_argument("--compact", action="store_true", help="few files per batch")
    stream.add_argument("--every", default="30 seconds", help="trigger interval")
    stream.add_argument("--drain", action="store_true", help="stop when all is ingested")

    stream.add_argument("--unique", metavar="TIME", help="store a key once within this time; with --records")

    job("refresh", "build the years whose inputs changed")
    compact = job("compact", "pack the batches of the student stream into larger files")
    compact.add_argument("--target-mb", type=int, default=256)
    compact.add_argument("--sweep", action="store_true", help="then empty what is packed; when no reader is left")

    job("checks", "store the expectations on the tables; fails on an error, not on a warning")
    register = job("register", "name the tables in the catalog")
    register.add_argument("--database", required=True, help="prefix of the database names")
    return parser.parse_args(argv)


def stream(store: Store, args: argparse.Namespace) -> None:
    if args.kafka:
        records = kafka_records(store.spark, args.kafka, args.topic, args.records_per_batch)
    elif args.unique:
        records = arriving_records(store.spark, args.records, args.files_per_batch)
        records = unique_rows(records, L.STUDENT_PAYLOAD, L.STUDENTS.keys, args.unique)
    else:
        records = file_records(store.spark, args.records, args.files_per_batch)
    out = store.path("bronze", L.STUDENT)
    writer = unique_writer if args.unique else batch_writer
    handler = writer(L.STUDENT_PAYLOAD, L.STUDENT, out, args.label, compact=args.compact)
    checkpoint = f"{store.root}/checkpoints/{L.STUDENT}/{args.label}"
    every = None if args.drain else args.every
    partitions = state_partitions(store.spark) if args.unique else None
    start_ingest(records, handler, checkpoint, every, partitions).awaitTermination()


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = arguments(argv)
    if args.job == "stream" and args.unique and args.kafka:
        raise SystemExit("--unique goes with --records")
    spark = SparkSession.builder.appName(f"terrace-{args.job}").getOrCreate()
    store = Store(spark, args.root)
    if args.job == "layers":
        run_layers(spark, args.root, layers=args.only, replace_all=args.replace_all)
    elif args.job == "stream":
        stream(store, args)
    elif args.job == "refresh":
        for report in refresh_layers(spark, args.root):
            print(report["layer"], report["entity"], *report["years"])
    elif args.job == "compact":
        out = store.path("bronze", L.STUDENT)
        print("\n".join(compact_batches(spark, out, target_bytes=args.target_mb << 20)))
        if args.sweep:
            sweep(spark, out)
    elif args.job == "register":
        print("\n".join(register_layers(store, args.database)))
    else:
        path = store.path("checks", "latest")
        write_layer(check_layers(store), path, partition_by=(), replace_all=True)
        checks = spark.read.parquet(path)
        failed = checks.filter("not passed").orderBy("layer", "entity", "check")
        for row in failed.toLocalIterator():
            print(*row, sep=" | ")
        return int(not failed.filter("level = 'error'").isEmpty())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
