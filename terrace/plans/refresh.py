"""Refresh of the layers by the years that changed.

Each layer is compared with what the layer above made of it last time: source files with
the raw tables, partitions of raw tables with the conformed ones, those with the analytical
table. Nothing is computed or written for a year whose inputs are as they were. A run that
is ended anywhere is made good by the next one: a year is noted only after it is written,
and writing it again replaces it.

A source file that changed is read once for a checksum of each year's rows, so that a file
with one corrected year rewrites one year. Dimensions describe all years: if one changes,
all conformed years are written anew.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.contracts import CompositeGroup, Dimension, EntityContract
from terrace.functions.lineage import Run
from terrace.plans import literacy as L
from terrace.plans.layers import (
    ANALYTICAL,
    CONFORMED,
    RAW,
    SOURCE,
    build_analytical,
    conform_entity,
    ingest_entity,
    load_dimensions,
)
from terrace.sources.changes import WHOLE, changed, noted, partition_files, write_note
from terrace.sources.csv import read_csv
from terrace.sources.layers import Store

log = logging.getLogger(__name__)

NOTES = "_notes"


def _note(store: Store, layer: str, name: str) -> str:
    return store.path(NOTES, f"{layer}_{name}")


def source_years(store: Store, contract: EntityContract) -> DataFrame:
    """Figures of a source file's rows by year, in the form of those of partitions.

    The checksum is a sum of row hashes, which neither order nor files change; malformed
    rows count as well, with the text they came as.
    """
    rows = read_csv(store.spark, store.path(SOURCE, contract.source_file), contract.source_schema)
    year = F.coalesce(F.col("ano").cast("string"), F.lit("__none__"))
    own = F.xxhash64(*[F.col(c) for c in rows.columns])
    return rows.groupBy(year.alias("partition")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count(F.lit(1)).alias("bytes"),
        F.sum((own % F.lit(1 << 40))).alias("checksum"),
    )


def _refresh_source(store: Store, contract: EntityContract, run: Run) -> dict[str, object] | None:
    files = partition_files(store.spark, store.path(SOURCE, contract.source_file), "ano", ".csv")
    of_file = _note(store, SOURCE, contract.name)
    if not changed(files, of_file):
        return None
    years, of_years = source_years(store, contract), _note(store, "years", contract.name)
    wanted = changed(years, of_years)
    report = ingest_entity(store, contract, run, years=wanted) if wanted else None
    write_note(years, of_years, wanted)
    write_note(files, of_file, [WHOLE])
    return report and {**report, "years": wanted}


def _dimension_files(store: Store, dimensions: Mapping[str, Dimension]) -> dict[str, DataFrame]:
    return {
        name: partition_files(store.spark, store.path(SOURCE, d.source_file), "ano", ".csv")
        for name, d in dimensions.items()
    }


def refresh_layers(
    spark: SparkSession,
    root: str,
    run: Run | None = None,
    contracts: Sequence[EntityContract] = L.CONTRACTS,
    dimensions: Mapping[str, Dimension] = L.DIMENSIONS,
    composites: Sequence[CompositeGroup] = L.COMPOSITES,
) -> list[dict[str, object]]:
    """Bring all layers up to date; a report of each table that was written, with its years.

    On inputs that did not change it writes nothing and returns an empty list. The first
    call on a root that :func:`run_layers` filled writes everything once. As there, a year
    that is gone from the sources stays.
    """
    run = run or Run()
    store = Store(spark, root)
    reports: list[dict[str, object]] = []
    for contract in contracts:
        if "ano" not in contract.keys:
            raise ValueError(f"{contract.name}: years can only be refreshed apart if the key has the year")
        if contract.source_file:
            report = _refresh_source(store, contract, run)
            reports += [report] if report else []

    described = _dimension_files(store, dimensions)
    new_dimensions = {n for n, f in described.items() if changed(f, _note(store, "dimension", n))}
    tables = load_dimensions(store, dimensions)
    for contract in contracts:
        figures = partition_files(spark, store.path(RAW, contract.name), "ano")
        note = _note(store, RAW, contract.name)
        wanted = changed(figures, note)
        if contract.dimension in new_dimensions:
            wanted = sorted(r[0] for r in figures.select("partition").collect())
        if wanted:
            report = conform_entity(store, contract, dimensions, tables, run, years=wanted)
            write_note(figures, note, wanted)
            reports += [{**report, "years": wanted}] if report else []
    for name in new_dimensions:
        write_note(described[name], _note(store, "dimension", name), [WHOLE])

    found = {c.name: partition_files(spark, store.path(CONFORMED, c.name), "ano") for c in contracts}
    by_entity = {name: changed(f, _note(store, CONFORMED, name)) for name, f in found.items()}
    years = sorted({y for own in by_entity.values() for y in own})
    if years:
        report = build_analytical(store, run, contracts, composites, years=years)
        for name, own in by_entity.items():
            write_note(found[name], _note(store, CONFORMED, name), own)
        reports.append({**report, "layer": ANALYTICAL, "years": years})
    for report in reports:
        log.info("refreshed %s", report)
    return reports


def up_to_date(spark: SparkSession, root: str, contracts: Sequence[EntityContract] = L.CONTRACTS) -> DataFrame:
    """``entity``, ``partition`` and ``current``: whether the conformed layer has seen this raw partition."""
    store = Store(spark, root)
    parts = []
    for contract in contracts:
        figures = partition_files(spark, store.path(RAW, contract.name), "ano")
        seen = noted(spark, _note(store, RAW, contract.name)).withColumn("seen", F.lit(True))
        joined = figures.join(seen, figures.columns, "left")
        parts.append(joined.select(F.lit(contract.name).alias("entity"), "partition", F.coalesce("seen", F.lit(False)).alias("current")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
