"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. ``--ablations`` times the
forms that were measured against each other instead; ``--all`` times every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.operators.dedup import deduplicate
from terrace.operators.metrics import group_sums, memberships, student_metrics
from terrace.plans import literacy as L
from terrace.plans import star
from terrace.plans.queries import QUERIES
from terrace.plans.star import load
from terrace.sources.layers import write_layer
from terrace.sources.scratch import scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "ingest_csv_contract",
    "store_partition_overwrite",
    "clean_cast_contract",
    "json_payload",
    "dedup_by_key",
    "dedup_audit",
    "enrich_hierarchy",
    "join_coverage",
    "metrics_by_group",
    "metrics_composite",
    "metrics_weighted",
    "target_of_year",
    "target_status",
    "unified_table",
    "report_country_by_year",
    "report_yoy",
    "report_kpis",
    "report_state_ranking",
    "report_histogram",
    "report_status_by_region",
    "report_top_n",
    "report_student_kpis",
    "report_diagnosis",
    "report_detail_search",
    "quality_report",
    "quality_duplicate_keys",
    "quality_rows_vs_ids",
    "quality_checks",
    "stream_ingest",
    "stream_replay",
    "stream_unique",
    "publish_resumed",
    "stream_compaction",
    "colocated_unique",
    "colocated_metrics",
    "report_distinct_sketch",
    "analysis_path",
    "analysis_inequality",
    "analysis_trend",
    "layered_run",
)
#: A query whose first run takes longer than this many seconds has one warm run only.
LONG = 10


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("terrace-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build: Callable[[], DataFrame | None]) -> tuple[float, list[float]]:
    """The cold run and the warm ones; every row is computed, none is brought to the driver.

    The cold run includes the inputs that a query stores for itself and others.
    """

    def once() -> float:
        start = time.perf_counter()
        df = build()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    cold = once()
    return cold, sorted(once() for _ in range(RUNS if cold < LONG else 1))


def union_of_three(facts: DataFrame) -> DataFrame:
    """Composite groups the plain way: one aggregate of the fact per kind of group."""
    keys = L.STUDENT_METRICS
    kept = facts.filter(F.col("rede").isin("A", "N")).withColumn("rede", F.lit("P"))
    everyone = facts.withColumn("rede", F.lit("T"))
    return (
        group_sums(facts, keys)
        .unionByName(group_sums(kept, keys))
        .unionByName(group_sums(everyone, keys))
    )


def explode_first(facts: DataFrame) -> DataFrame:
    """Composite groups by copying every person into each of their groups."""
    spread = facts.withColumn("rede", F.explode(memberships(F.col("rede"), star.COMPOSITES)))
    return group_sums(spread, L.STUDENT_METRICS)


LINES = "dedup_lines"


def dedup_forms(rows: DataFrame, name: str) -> dict[str, Callable[[], DataFrame]]:
    """One row a key in three ways: reduced before the shuffle, after it, and by a window."""
    keys = ["l_orderkey", "l_linenumber"]
    order = [c for c in rows.columns if c not in keys]
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])

    def windowed() -> DataFrame:
        ranked = rows.withColumn("place", F.row_number().over(latest))
        return ranked.filter("place = 1").drop("place")

    return {
        f"{name}_reduce_first": lambda: deduplicate(rows, keys),
        f"{name}_shuffle_first": lambda: deduplicate(rows.repartition(*keys), keys),
        f"{name}_window": windowed,
    }


def ablations(spark: SparkSession) -> dict[str, Callable[[], DataFrame | None]]:
    facts = star.students(spark, SF_DIR)
    lines = load(spark, SF_DIR, "lineitem")
    places = star.places(spark, SF_DIR)
    dated = lines.withColumn("ano", F.year("l_shipdate"))

    def count_then_write() -> None:
        dated.count()
        dated.write.partitionBy("ano").parquet(scratch_path(spark, "counted"))

    def observed_write() -> None:
        write_layer(dated, scratch_path(spark, "observed"))

    # Eight times the rows, a third of them under one key.
    many = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(8)))).withColumn(
        "l_orderkey", F.when(F.col("copy") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey") * 8 + F.col("copy"))
    ).withColumn("l_linenumber", F.when(F.col("l_orderkey") == 1, F.lit(1)).otherwise(F.col("l_linenumber"))).drop("copy")

    def joined(hint: str) -> DataFrame:
        return facts.join(places.hint(hint), "id_municipio", "left")

    return {
        "composite_union_of_three": lambda: union_of_three(facts),
        "composite_explode_first": lambda: explode_first(facts),
        "composite_aggregate_first": lambda: student_metrics(
            facts, L.STUDENT_METRICS, star.COMPOSITES
        ),
        "count_then_write": count_then_write,
        "observed_write": observed_write,
        "dimension_broadcast": lambda: joined("broadcast"),
        "dimension_merge": lambda: joined("merge"),
        **dedup_forms(lines, LINES),
        **dedup_forms(many, f"{LINES}_8x_hot"),
        "dedup_drop_duplicates": lambda: lines.dropDuplicates(["l_orderkey", "l_linenumber"]),
        "dedup_by_key": lambda: QUERIES["dedup_by_key"](spark, SF_DIR),
    }


def main() -> None:
    spark = session()
    if "--ablations" in sys.argv:
        times = {name: seconds(build) for name, build in ablations(spark).items()}
    else:
        names = list(QUERIES) if "--all" in sys.argv else HEADLINE
        times = {
            name: seconds(lambda query=QUERIES[name]: query(spark, SF_DIR)) for name in names
        }
    medians = {name: round(statistics.median(warm), 3) for name, (_, warm) in times.items()}
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "cold": {name: round(cold, 3) for name, (cold, _) in times.items()},
                "spread": {name: round(warm[-1] - warm[0], 3) for name, (_, warm) in times.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
