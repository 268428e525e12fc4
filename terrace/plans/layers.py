"""The layered run: raw, conformed, analytical, and checks on what came out."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.contracts import CompositeGroup, Dimension, EntityContract
from terrace.functions.lineage import Run, analytical_lineage, conformed_lineage, raw_lineage
from terrace.operators.clean import blanks_to_null, cast_by_contract, decode, standard_names
from terrace.operators.dedup import deduplicate, lacks_key, without_key
from terrace.operators.joins import add_dimension
from terrace.operators.quality import table_checks
from terrace.plans import literacy as L
from terrace.plans.analytical import analytical_table
from terrace.sources.catalog import register
from terrace.sources.csv import CORRUPT, file_path, read_csv, rejected_rows, valid_rows
from terrace.sources.dimensions import read_dimension
from terrace.sources.layers import Store, write_layer
from terrace.streaming.ingest import read_ingested

log = logging.getLogger(__name__)

SOURCE, RAW, CONFORMED, ANALYTICAL, QUARANTINE = (
    "arquivos",
    "bronze",
    "silver",
    "gold",
    "quarantine",
)
COPIES = "_copies_of_key"


def of_years(df: DataFrame, years: Sequence[str] | None, column: str = "ano") -> DataFrame:
    """Rows of these years, named as in paths; all of them if none are named.

    The year is compared as a number, so that the filter reaches the partitions.
    """
    if years is None or column not in df.columns:
        return df
    numbers = [int(y) for y in years if y.isdigit()]
    wanted = F.col(column).isin(numbers)
    if len(numbers) < len(years):  # rows without a year have a partition of their own
        wanted = wanted | F.col(column).isNull()
    return df.filter(wanted)


def ingest_entity(
    store: Store,
    contract: EntityContract,
    run: Run,
    replace_all: bool = False,
    years: Sequence[str] | None = None,
) -> dict[str, object]:
    """One source file to the raw layer; malformed rows to the quarantine of this run.

    The write notices whether there was any malformed row; only then the file is read a
    second time to store them, so a clean file is read once. With ``years`` only rows of
    these years are written.
    """
    source = store.path(SOURCE, contract.source_file)
    rows = read_csv(store.spark, source, contract.source_schema)
    rows = of_years(raw_lineage(rows, run, contract.source_file, file_path()), years)
    noticed = Observation()
    figures = write_layer(
        valid_rows(rows.observe(noticed, F.count_if(F.col(CORRUPT).isNotNull()).alias("n"))),
        store.path(RAW, contract.name),
        partition_by=contract.partition_by,
        compact=contract.compact,
        replace_all=replace_all,
    )
    rejected = 0
    if noticed.get.get("n"):
        quarantine = f"{store.path(QUARANTINE, contract.name)}/run={run.stamp}"
        rejected = write_layer(
            rejected_rows(rows), quarantine, partition_by=(), replace_all=True
        )["rows"]
    report = {"layer": RAW, "entity": contract.name, **figures, "rejected": rejected}
    log.info("%s", report)
    return report


def clean_rows(raw: DataFrame, contract: EntityContract) -> DataFrame:
    """Names, blanks, types and codes by the contract; a projection."""
    table = cast_by_contract(blanks_to_null(standard_names(raw)), contract)
    for codes in contract.codes:
        table = decode(table, codes)
    return table


def conform(
    raw: DataFrame,
    contract: EntityContract,
    dimensions: Mapping[str, Dimension],
    dimension_tables: Mapping[str, DataFrame],
    run: Run,
    copies: str | None = None,
    keyless: Observation | None = None,
) -> DataFrame:
    """All cleaning steps of the contract, as one plan with a single shuffle (the key).

    Rows with a null in the key are left out; ``keyless`` counts them as ``n``.
    """
    table = clean_rows(raw, contract)
    if keyless:
        table = table.observe(keyless, F.count_if(lacks_key(table, contract.keys)).alias("n"))
    table = deduplicate(table, contract.keys, ("_ingestion_timestamp",), copies)
    table = add_dimension(table, dimensions.get(contract.dimension), dimension_tables)
    return conformed_lineage(table, run, contract.name)


def read_raw(store: Store, contract: EntityContract) -> DataFrame | None:
    """Raw rows of an entity, loaded from a file or from the stream; none if never ingested."""
    if contract.source_file is None:
        return read_ingested(store.spark, store.path(RAW, contract.name))
    return store.read_if_present(RAW, contract.name)


def conform_entity(
    store: Store,
    contract: EntityContract,
    dimensions: Mapping[str, Dimension],
    dimension_tables: Mapping[str, DataFrame],
    run: Run,
    replace_all: bool = False,
    years: Sequence[str] | None = None,
) -> dict[str, object] | None:
    """Raw to conformed layer, with the quality figures taken by the write itself.

    With ``years`` only these are read and replaced.

    Rows with a null in the key go to the quarantine of this run; they are read a second
    time only if the write noticed some.
    """
    raw = read_raw(store, contract)
    if raw is None:
        log.warning("no raw table, skipped: %s", contract.name)
        return None
    raw = of_years(raw, years)
    keyless = Observation()
    table = conform(raw, contract, dimensions, dimension_tables, run, COPIES, keyless)
    figures = write_layer(
        table,
        store.path(CONFORMED, contract.name),
        partition_by=contract.partition_by,
        compact=contract.compact,
        replace_all=replace_all,
        watch=[
            F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_before"),
            F.min("ano").alias("first_year"),
            F.max("ano").alias("last_year"),
            *[
                F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")
                for c in contract.critical
                if c in table.columns
            ],
        ],
        hide=[COPIES],
    )
    report = {"layer": CONFORMED, "entity": contract.name, **figures}
    report["removed"] = report["rows_before"] - report["rows"]
    report["without_key"] = keyless.get.get("n") or 0
    if report["without_key"]:
        aside = f"{store.path(QUARANTINE, f'{contract.name}_without_key')}/run={run.stamp}"
        rows = without_key(clean_rows(raw, contract), contract.keys)
        write_layer(rows, aside, partition_by=(), replace_all=True)
    log.info("%s", report)
    return report


def build_analytical(
    store: Store,
    run: Run,
    contracts: Sequence[EntityContract] = L.CONTRACTS,
    composites: Sequence[CompositeGroup] = L.COMPOSITES,
    replace_all: bool = False,
    years: Sequence[str] | None = None,
) -> dict[str, object]:
    """Conformed tables to the analytical table; fails at once if a required one is missing.

    With ``years`` only these are read and replaced: all its joins are within a year.
    """
    tables = store.read_present(CONFORMED, [c.name for c in contracts], L.REQUIRED)
    tables = {name: of_years(table, years) for name, table in tables.items()}
    table = analytical_lineage(analytical_table(tables, composites), run, store.root)
    figures = write_layer(
        table, store.path(ANALYTICAL, L.ANALYTICAL), compact=True, replace_all=replace_all
    )
    report = {"layer": ANALYTICAL, "entity": L.ANALYTICAL, **figures}
    log.info("%s", report)
    return report


def check_layers(store: Store, contracts: Sequence[EntityContract] = L.CONTRACTS) -> DataFrame:
    """Expectations on all conformed tables and the analytical one, one row per check.

    An absent table is a row "present": an error if the layers need it, else a warning.
    """
    analytical = EntityContract(
        name=L.ANALYTICAL,
        keys=("ano", "id_municipio", "serie", "rede"),
        critical=("ano", "id_municipio"),
        dimension="uf",
    )
    checks = []
    for layer, contract in [(CONFORMED, c) for c in contracts] + [(ANALYTICAL, analytical)]:
        table = store.read_if_present(layer, contract.name)
        if table is None:
            needed = layer == ANALYTICAL or contract.name in L.REQUIRED
            level = "error" if needed else "warning"
            absent = (contract.name, "present", level, 0, False, layer)
            checks.append(
                store.spark.createDataFrame(
                    [absent],
                    "entity string, check string, level string, found bigint, passed boolean,"
                    " layer string",
                )
            )
        else:
            checks.append(table_checks(table, contract).withColumn("layer", F.lit(layer)))
    return reduce(DataFrame.unionByName, checks)


def register_layers(
    store: Store, prefix: str, contracts: Sequence[EntityContract] = L.CONTRACTS
) -> list[str]:
    """Name the tables of all layers in the catalog, one database per layer."""
    entities = {
        RAW: [c.name for c in contracts],
        CONFORMED: [c.name for c in contracts],
        ANALYTICAL: [L.ANALYTICAL],
    }
    return [
        register(store.spark, f"{prefix}_{layer}", layer, name, store.path(layer, name))
        for layer, names in entities.items()
        for name in names
        if store.read_if_present(layer, name) is not None
    ]


def load_dimensions(
    store: Store, dimensions: Mapping[str, Dimension] = L.DIMENSIONS
) -> dict[str, DataFrame]:
    """Dimension tables; the planner chooses how they are joined."""
    return {
        name: read_dimension(store.spark, store.path(SOURCE, d.source_file), d)
        for name, d in dimensions.items()
    }


def run_layers(
    spark: SparkSession,
    root: str,
    run: Run | None = None,
    contracts: Sequence[EntityContract] = L.CONTRACTS,
    dimensions: Mapping[str, Dimension] = L.DIMENSIONS,
    composites: Sequence[CompositeGroup] = L.COMPOSITES,
    layers: Sequence[str] = (RAW, CONFORMED, ANALYTICAL),
    replace_all: bool = False,
) -> list[dict[str, object]]:
    """The chosen layers in their order; the first failure ends the run.

    Student records come in by stream beforehand. A second run replaces the partitions
    it writes and leaves the result as it was. A year that is gone from the sources stays
    in the layers unless ``replace_all`` rewrites the tables as a whole.
    """
    run = run or Run()
    store = Store(spark, root)
    reports: list[dict[str, object]] = []
    if RAW in layers:
        files = [c for c in contracts if c.source_file]
        reports += [ingest_entity(store, c, run, replace_all) for c in files]
    if CONFORMED in layers:
        tables = load_dimensions(store, dimensions)
        figures = [
            conform_entity(store, c, dimensions, tables, run, replace_all) for c in contracts
        ]
        reports += [r for r in figures if r is not None]
    if ANALYTICAL in layers:
        reports.append(build_analytical(store, run, contracts, composites, replace_all))
    return reports
