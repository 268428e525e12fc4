"""One query per operator or operator group, over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.contracts import CodeList, Dimension, EntityContract, PayloadSpec, Slice
from terrace.functions.lineage import Run, analytical_lineage, conformed_lineage, raw_lineage
from terrace.functions.numbers import exact_mean
from terrace.functions.slices import apply_slice
from terrace.functions.targets import gap_to_target, target_of_year, target_status
from terrace.operators import clean, joins, metrics, quality
from terrace.operators.dedup import dedup_audit, deduplicate, without_key
from terrace.plans import literacy as L
from terrace.plans import reports, star
from terrace.plans.analytical import analytical_table, targets_for
from terrace.plans.layers import check_layers, run_layers
from terrace.plans.star import load
from terrace.sources.catalog import column_names, register
from terrace.sources.csv import CORRUPT, entity_of_path, file_path, read_csv, valid_rows
from terrace.sources.dimensions import conform_dimension
from terrace.sources.layers import (
    MissingInput,
    Store,
    export_csv,
    read_if_present,
    write_layer,
)
from terrace.sources.scratch import scratch_path
from terrace.streaming.ingest import (
    batch_writer,
    drain,
    file_records,
    ingest_status,
    read_ingested,
    start_ingest,
    stop_ingest,
)
from terrace.streaming.publish import publish
from terrace.streaming.records import parse_records, to_records

Query = Callable[[SparkSession, str], DataFrame]

RUN = Run(datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc))
YEAR = 1997
WANTED = Slice(year=YEAR, network="T")
IN_REGION = Slice(year=YEAR, network="T", region="ASIA")
LINE_KEY = ("l_orderkey", "l_linenumber")

ORDER_STATUS = CodeList("o_orderstatus", "status_name", (("F", "Final"), ("O", "Open")))

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)

EVENT_PAYLOAD = PayloadSpec(
    fields=("ano", "event_id", "user_id", "event_type", "value", "k"),
    typed=(("value", "double"), ("k", "int")),
)


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumn("ano", F.year("o_orderdate"))


# --- Part A: ingest and store ---------------------------------------------------------


def ingest_csv_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_path(spark, 'csv')}/raw_customer.csv"
    export_csv(load(spark, sf_dir, "customer"), path)
    directory = F.regexp_replace(file_path(), "/[^/]*$", "")
    rows = read_csv(spark, path, CUSTOMER_SCHEMA)
    return valid_rows(rows.withColumn("entity", entity_of_path(directory, "raw_")))


def ingest_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    raw = raw_lineage(orders, RUN, "orders.csv", "arquivos/orders.csv")
    conformed = conformed_lineage(raw, RUN, "orders").drop("_pipeline_stage")
    return analytical_lineage(conformed, RUN, "root")


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt get a balance that is no number; their rows must be set aside."""
    balance = F.when(F.col("c_acctbal") < 0, "in debt").otherwise(
        F.col("c_acctbal").cast("string")
    )
    path = f"{scratch_path(spark, 'csv')}/customer.csv"
    export_csv(load(spark, sf_dir, "customer").withColumn("c_acctbal", balance), path)
    rows = read_csv(spark, path, CUSTOMER_SCHEMA)
    return rows.select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
        F.when(F.col(CORRUPT).isNull(), "valid").otherwise("rejected").alias("record_status"),
    )


def store_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years written, then one of them again with a new status."""
    path = scratch_path(spark, "orders")
    columns = ("o_orderkey", "o_orderstatus", "o_totalprice", "ano")
    orders = dated_orders(spark, sf_dir).select(*columns)
    write_layer(orders, path)
    write_layer(
        orders.filter(F.col("ano") == YEAR).withColumn("o_orderstatus", F.lit("X")), path
    )
    return spark.read.parquet(path).select(*columns)


def store_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without the partition column is stored as one directory, twice with one result."""
    path = scratch_path(spark, "customer")
    for _ in range(2):
        write_layer(load(spark, sf_dir, "customer"), path)
    return spark.read.parquet(path)


def store_file_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders grouped by year for the write; rows, and whether a year has no more files than it needs."""
    path = scratch_path(spark, "orders")
    write_layer(dated_orders(spark, sf_dir), path, compact=True)
    per_file = (
        spark.read.parquet(path)
        .withColumn("file", file_path())
        .groupBy("file", "ano")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_orderkey")).alias("k"))
    )
    # A row is well below 256 bytes where it is shuffled, and a file is filled up to 64 MB.
    most = 1 + F.floor(F.sum("n") * 256 / (64 << 20)) * 2
    return per_file.groupBy("ano").agg(
        F.sum("n").alias("n"),
        F.sum("k").alias("sum_orderkey"),
        (F.count(F.lit(1)) <= most).alias("few_files"),
    )


def store_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders registered as an external table: rows per partition, and the columns it lists."""
    path = scratch_path(spark, "orders")
    write_layer(dated_orders(spark, sf_dir), path)
    name = register(spark, "terrace_silver", "silver", "orders", path)
    listed = ",".join(column_names(spark, name))
    return (
        spark.table(name)
        .groupBy("ano")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("listed_columns", F.lit(listed))
    )


def store_optional_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analytical table from a store that holds only the two required tables."""
    tables = star.conformed(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "store"))
    for name in L.REQUIRED:
        write_layer(tables[name], store.path("silver", name), compact=True)
    found = store.read_present("silver", [c.name for c in L.CONTRACTS], L.REQUIRED)
    return analytical_table(found, star.COMPOSITES)


def store_required_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store without one of the required tables: the rows of the other, and the error."""
    store = Store(spark, scratch_path(spark, "store"))
    present, absent = L.REQUIRED
    table = star.conformed(spark, sf_dir)[present]
    write_layer(table, store.path("silver", present), compact=True)
    message = "none"
    try:
        store.read_present("silver", (present, absent), L.REQUIRED)
    except MissingInput as error:
        message = str(error)
    rows = store.read("silver", present).agg(F.count(F.lit(1)).alias("rows_present"))
    return rows.withColumn("message", F.lit(message))


def export_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    chosen = ("id_municipio", "serie", "rede_nome", "taxa_alfabetizacao_municipio")
    table = apply_slice(star.stored_unified(spark, sf_dir), Slice(year=YEAR))
    export_csv(table.select(*chosen), path)
    return spark.read.option("header", True).schema(table.select(*chosen).schema).csv(path)


# --- Part B: clean and conform --------------------------------------------------------


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    untidy = ["Código do Cliente", " NOME ", "Nação--Chave", "Saldo (R$)", "_Segmento Técnico"]
    return clean.standard_names(load(spark, sf_dir, "customer").toDF(*untidy))


def clean_empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names padded, and the type emptied for small parts."""
    part = load(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.when(F.col("p_size") < 10, "   ").otherwise(F.col("p_type")).alias("p_type"),
        F.concat(F.lit(" "), "p_brand").alias("_p_brand"),
    )
    return clean.blanks_to_null(part)


def clean_cast_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text; the priority goes into a number column and only its digit forms fit."""
    text = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id_pedido"),
        F.concat(F.year("o_orderdate"), F.lit(".0")).alias("ano"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.regexp_replace("o_orderpriority", "-.*(H|W)$", "").alias("meta_alfabetizacao_2024"),
        F.col("o_custkey").alias("id_cliente"),
    )
    contract = EntityContract(
        name="orders",
        keys=("id_pedido",),
        integers=("ano", "absent"),
        doubles=("total",),
        texts=("id_pedido", "id_cliente"),
        double_prefixes=(L.TARGET_PREFIX,),
    )
    return clean.cast_by_contract(text, contract)


def clean_guarded_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as text, empty for errors."""
    emptied = F.col("event_type") == "error"
    text = load(spark, sf_dir, "events").select(
        "event_id",
        F.year("ts").alias("ano"),
        F.when(emptied, "").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(emptied, "").otherwise(F.get_json_object("props", "$.k")).alias("k"),
    )
    return clean.type_payload(text, EVENT_PAYLOAD)


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return clean.decode(orders, ORDER_STATUS)


def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to JSON records in bytes, and back to typed columns."""
    parsed = parse_records(to_records(event_rows(spark, sf_dir), "user_id"), EVENT_PAYLOAD)
    return parsed.drop("raw_record").withColumn("ano", F.col("ano").try_cast("int"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a publisher holds them: text fields only."""
    return load(spark, sf_dir, "events").select(
        F.year("ts").cast("string").alias("ano"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.when(F.col("event_type") == "error", "")
        .otherwise(F.col("value").cast("string"))
        .alias("value"),
        F.get_json_object("props", "$.k").alias("k"),
    )


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(load(spark, sf_dir, "lineitem"), LINE_KEY, ("l_shipdate",), "copies")


def dedup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order number of every tenth order is lost: its lines are set aside and counted."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber",
        "l_shipdate",
    )
    aside = without_key(lines, LINE_KEY).agg(F.count(F.lit(1)))
    kept = deduplicate(lines, LINE_KEY, ("l_shipdate",), "copies")
    return kept.withColumn("rows_without_key", aside.scalar())


def dedup_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_audit(load(spark, sf_dir, "lineitem"), LINE_KEY)


def dim_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a dimension, with padded names and every row twice."""
    padded = load(spark, sf_dir, "customer").withColumn("c_name", F.concat("c_name", F.lit("  ")))
    dimension = Dimension(
        "customer",
        "id_cliente",
        (("c_custkey", "id_cliente"), ("c_name", "nome"), ("c_mktsegment", "segmento")),
    )
    return conform_dimension(padded.unionByName(load(spark, sf_dir, "customer")), dimension)


def enrich_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    dimension = Dimension("nation", "c_nationkey", ())
    return joins.add_dimension(load(spark, sf_dir, "customer"), dimension, {"nation": nation})


def enrich_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = star.places(spark, sf_dir)
    dimension = Dimension("places", "id_municipio", ())
    lines = star.students(spark, sf_dir).select(
        "ano", "id_municipio", "id_aluno", "id_escola", "alfabetizado"
    )
    return joins.add_dimension(lines, dimension, {"places": places})


def join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against the users that have events."""
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    return joins.join_coverage(load(spark, sf_dir, "customer"), users, "c_custkey")


def join_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = load(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    return joins.orphans(load(spark, sf_dir, "customer"), users, "c_custkey")


# --- Part C: metrics and the unified table --------------------------------------------


def metrics_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = metrics.group_sums(star.students(spark, sf_dir), L.STUDENT_METRICS)
    return _sums_as_double(sums)


def _sums_as_double(sums: DataFrame) -> DataFrame:
    decimal_sums = ("soma_proficiencia", "soma_proficiencia_peso", "soma_peso")
    merged = sums.drop(*[c for c in metrics.SUMS if c.startswith("dupla_")], "n_inexatos")
    return merged.withColumns({c: F.col(c).cast("double") for c in decimal_sums})


def metrics_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = metrics.group_sums(star.students(spark, sf_dir), L.STUDENT_METRICS)
    return _sums_as_double(
        metrics.with_composites(sums, L.STUDENT_METRICS, star.COMPOSITES)
    )


def _metrics(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    table = metrics.student_metrics(
        star.students(spark, sf_dir), L.STUDENT_METRICS, star.COMPOSITES
    )
    return table.select("ano", "id_municipio", "serie", "rede", *columns)


def metrics_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "proporcao_presenca", "taxa_alfabetizacao_observada")


def metrics_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "proficiencia_media")


def metrics_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "proficiencia_media_ponderada")


def _yearly(facts: DataFrame, measure: str) -> DataFrame:
    columns = replace(L.STUDENT_METRICS, groups=("ano",))
    return metrics.student_metrics(facts, columns, star.COMPOSITES).select("ano", "rede", measure)


def metrics_weighted_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights as shares of the population, far below a millionth on a large table."""
    people = load(spark, sf_dir, "lineitem").agg(F.count(F.lit(1))).scalar()
    facts = star.students(spark, sf_dir)
    shares = facts.withColumn("peso_aluno", F.col("peso_aluno") / people)
    return _yearly(shares, "proficiencia_media_ponderada")


def metrics_mean_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores beyond what millionths hold; the mean is given in billions."""
    facts = star.students(spark, sf_dir)
    large = facts.withColumn("proficiencia", F.col("proficiencia") * 1e9)
    mean = F.round(F.col("proficiencia_media") / 1e9, 2).alias("mean_in_billions")
    return _yearly(large, "proficiencia_media").select("ano", "rede", mean)


def mean_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean per region and segment of the nations' mean balances."""
    located = load(spark, sf_dir, "customer").join(
        load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    nations = located.groupBy("n_regionkey", "n_nationkey", "c_mktsegment").agg(
        exact_mean(F.col("c_acctbal")).alias("mean_acctbal")
    )
    return metrics.mean_of_groups(
        nations, ["n_regionkey", "c_mktsegment"], {"mean_acctbal": "mean_of_nations"}
    )


def _with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star.published(spark, sf_dir)
    target = targets_for(tables[L.MUNICIPAL_TARGET], "municipio", ("id_municipio",))
    result = tables[L.MUNICIPAL_RESULT].select(
        "ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao"
    )
    return joins.add_columns(result, target, ("ano", "id_municipio"), "target")


def target_of_year_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide targets of every nation and year meet the line items of that year."""
    number = F.col("n_nationkey")
    value = F.when(number % 7 != 0, (number % 7 + 49).cast("double"))
    wide = load(spark, sf_dir, "nation").select(
        number, *[(value + F.lit(y - 1996)).alias(f"target_{y}") for y in star.TARGET_YEARS]
    )
    groups = (
        load(spark, sf_dir, "lineitem")
        .join(load(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.year("l_shipdate").alias("ano"), F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = groups.join(wide, "n_nationkey", "left")
    picked = target_of_year(joined.columns, "target_", F.col("ano")).alias("target")
    return joined.select("ano", "n_nationkey", "n", picked)


def target_status_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao_municipio")
    return _with_target(spark, sf_dir).withColumn("status", target_status(value, target))


def target_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao_municipio")
    return _with_target(spark, sf_dir).select(
        "ano", "id_municipio", "serie", "rede", gap_to_target(value, target).alias("gap")
    )


def unified_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.unified(spark, sf_dir)


# --- Part D: reports ------------------------------------------------------------------


def report(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(star.stored_unified(spark, sf_dir))


def student_section_sizes(table: DataFrame) -> DataFrame:
    """Rows of each report on students, and how many there are without student columns."""
    plain = table.drop(*reports.STUDENT_COLUMNS)
    sections = reports.student_section(table, WANTED)
    return quality.row_counts(sections).withColumn(
        "sections_without", F.lit(len(reports.student_section(plain, WANTED)))
    )


REPORTS: dict[str, Query] = {
    "report_years_networks": report(reports.years_and_networks),
    "report_territories": report(reports.territories),
    "report_territories_of_region": report(lambda t: reports.territories(t, "ASIA")),
    "report_country_by_year": report(reports.country_by_year),
    "report_yoy": report(reports.country_change),
    "report_kpis": report(lambda t: reports.slice_kpis(t, WANTED)),
    "report_kpis_region": report(lambda t: reports.slice_kpis(t, IN_REGION)),
    "report_state_ranking": report(lambda t: reports.state_ranking(t, WANTED)),
    "report_histogram": report(lambda t: reports.rate_histogram(t, WANTED)),
    "report_status_by_region": report(lambda t: reports.status_by_region(t, WANTED)),
    "report_top_n": report(lambda t: reports.extremes(t, WANTED)),
    "report_bottom_n": report(lambda t: reports.extremes(t, IN_REGION, highest=False)),
    "report_student_kpis": report(lambda t: reports.student_kpis(t, WANTED)),
    "report_scatter": report(lambda t: reports.attendance_and_rate(t, WANTED, limit=None)),
    "report_crosstab": report(lambda t: reports.status_crosstab(t, WANTED)),
    "report_diagnosis": report(lambda t: reports.below_target_diagnosis(t, WANTED)),
    "report_detail": report(lambda t: reports.detail(t, WANTED)),
    "report_detail_limit": report(lambda t: reports.detail(t, WANTED, limit=5)),
    "report_scatter_limit": report(
        lambda t: reports.attendance_and_rate(t, Slice(year=YEAR), limit=7)
    ),
    "report_student_section": report(lambda t: student_section_sizes(t)),
    "report_detail_search": report(lambda t: reports.detail(t, WANTED, search="PPLIER#00000001")),
}


def report_top_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_results(star.published(spark, sf_dir)[L.STATE_RESULT], YEAR)


# --- Part E: quality and stream -------------------------------------------------------


def quality_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        clean_guarded_cast(spark, sf_dir), "events", ("event_id", "value", "k", "absent")
    )


def quality_report_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = star.published(spark, sf_dir)[L.MUNICIPAL_RESULT]
    return quality.quality_report(
        table, "municipal", ("ano", "taxa_alfabetizacao", "media_portugues")
    )


def quality_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_count(clean_guarded_cast(spark, sf_dir), "value")


def quality_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(load(spark, sf_dir, "lineitem"), LINE_KEY)


def quality_rows_vs_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rows_and_ids(load(spark, sf_dir, "lineitem"), "l_orderkey")


def quality_code_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.code_pairs(decode_codes(spark, sf_dir), "o_orderstatus", "status_name")


def quality_status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = star.stored_unified(spark, sf_dir)
    return quality.status_distribution(table, "meta_atingida_municipio")


def quality_status_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = star.stored_unified(spark, sf_dir)
    return quality.status_distribution(table, "meta_atingida_municipio", ["ano"])


def quality_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("lineitem", "orders", "customer", "events")
    return quality.row_counts({name: load(spark, sf_dir, name) for name in names})


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expectations on the line items as students: keys repeat, and some places are unknown."""
    known = star.places(spark, sf_dir).filter(F.col("number") < 20)
    located = joins.add_dimension(
        star.students(spark, sf_dir),
        Dimension("places", "id_municipio", ()),
        {"places": known.select("id_municipio", "nome_uf")},
    )
    return quality.table_checks(located, L.STUDENTS)


def quality_checks_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store with the municipal results only: what the checks say about the absent tables."""
    store = Store(spark, scratch_path(spark, "store"))
    table = star.conformed(spark, sf_dir)[L.MUNICIPAL_RESULT]
    write_layer(table, store.path("silver", L.MUNICIPAL_RESULT), compact=True)
    contracts = [c for c in star.CONTRACTS if c.name in L.REQUIRED or c.name == L.STUDENT]
    found = check_layers(store, contracts).filter(F.col("check").isin("has rows", "present"))
    return found.select("layer", "entity", "check", "level", "found", "passed")


def ingest_events(spark: SparkSession, root: str, published: str, label: str) -> None:
    handler = batch_writer(EVENT_PAYLOAD, "events", f"{root}/bronze", label, lambda: RUN)
    drain(file_records(spark, published, 8), handler, f"{root}/checkpoints/{label}")


def published_events(spark: SparkSession, sf_dir: str, root: str) -> str:
    publish(event_rows(spark, sf_dir), "user_id", f"{root}/published", 5_000)
    return f"{root}/published"


EVENT_COLUMNS = ("ano", "event_id", "user_id", "event_type", "value", "k")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as records, ingested by stream, read back from the raw layer."""
    root = scratch_path(spark, "stream")
    ingest_events(spark, root, published_events(spark, sf_dir, root), "first")
    return read_ingested(spark, f"{root}/bronze").select(
        *EVENT_COLUMNS, "_ingestion_timestamp", "_source_entity"
    )


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records twice with the same checkpoint and once with a fresh one; no extra rows."""
    root = scratch_path(spark, "stream")
    published = published_events(spark, sf_dir, root)
    for label in ("first", "first", "second"):
        ingest_events(spark, root, published, label)
    ingested = read_ingested(spark, f"{root}/bronze").select(*EVENT_COLUMNS)
    return deduplicate(ingested, ("ano", "event_id"), copies="copies")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth value is no number and some years are none: these records are set aside."""
    number = F.col("event_id").cast("bigint")
    spoiled = event_rows(spark, sf_dir).withColumns(
        {
            "value": F.when(
                (number % 10 == 0) & (F.col("value") != ""), F.concat(F.lit("x"), "value")
            ).otherwise(F.col("value")),
            "ano": F.when(number % 25 == 1, "20x4").otherwise(F.col("ano")),
        }
    )
    root = scratch_path(spark, "stream")
    publish(spoiled, "user_id", f"{root}/published", 5_000)
    ingest_events(spark, root, f"{root}/published", "first")
    return spark.read.parquet(f"{root}/bronze").select(
        "ano",
        "event_id",
        "value",
        "record_status",
        F.get_json_object("raw_record", "$.event_id").alias("raw_event_id"),
    )


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty batch leaves nothing behind; the next one is written."""
    root = scratch_path(spark, "stream")
    records = spark.read.parquet(published_events(spark, sf_dir, root))
    write = batch_writer(EVENT_PAYLOAD, "events", f"{root}/bronze", "first", lambda: RUN)
    write(records.limit(0), 0)
    written = read_if_present(spark, f"{root}/bronze") is not None
    write(records, 1)
    per_year = read_ingested(spark, f"{root}/bronze").groupBy("ano")
    return per_year.agg(F.count(F.lit(1)).alias("n")).withColumn("empty_written", F.lit(written))


def stream_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream on an interval: started, asked for its state, stopped; rows ingested by year."""
    root = scratch_path(spark, "stream")
    records = file_records(spark, published_events(spark, sf_dir, root))
    write = batch_writer(EVENT_PAYLOAD, "events", f"{root}/bronze", "first", lambda: RUN)
    running = start_ingest(records, write, f"{root}/checkpoint", every="1 second")
    try:
        running.processAllAvailable()
        before = ingest_status(running)["active"]
    finally:
        stop_ingest(running)
    per_year = read_ingested(spark, f"{root}/bronze").groupBy("ano")
    return per_year.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {
            "active_before": F.lit(before),
            "active_after": F.lit(ingest_status(running)["active"]),
        }
    )


def export_star_sources(spark: SparkSession, sf_dir: str, store: Store) -> None:
    """The published tables and the dimensions as source files of the layers."""
    for name, table in star.published(spark, sf_dir).items():
        schema = next(c.source_schema for c in star.CONTRACTS if c.name == name)
        source = store.path("arquivos", f"{L.SOURCE_PREFIX}{name}.csv")
        export_csv(table.select(*schema.fieldNames()), source)
    places = star.places(spark, sf_dir)
    export_csv(
        places.select(*[F.col(ours).alias(theirs) for theirs, ours in L.MUNICIPALITIES.columns]),
        store.path("arquivos", L.MUNICIPALITIES.source_file),
    )
    export_csv(
        places.select(*[F.col(ours).alias(theirs) for theirs, ours in L.STATES.columns]),
        store.path("arquivos", L.STATES.source_file),
    )


def layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files and a stream through all layers; the analytical table as stored."""
    root = scratch_path(spark, "layers")
    store = Store(spark, root)
    export_star_sources(spark, sf_dir, store)
    for _ in range(2):  # the second call finds all ranges noted and writes none
        publish(star.students(spark, sf_dir), "id_aluno", f"{root}/published", 50_000)
    handler = batch_writer(
        L.STUDENT_PAYLOAD, "students", store.path("bronze", L.STUDENT), "first", lambda: RUN
    )
    drain(file_records(spark, f"{root}/published"), handler, f"{root}/checkpoint")
    run_layers(spark, root, RUN, star.CONTRACTS, L.DIMENSIONS, star.COMPOSITES)
    return store.read("gold", L.ANALYTICAL).select(*L.ANALYTICAL_COLUMNS, *L.SLICE_SUMS)


QUERIES: dict[str, Query] = {
    "ingest_csv_contract": ingest_csv_contract,
    "ingest_audit_columns": ingest_audit_columns,
    "ingest_quarantine": ingest_quarantine,
    "store_partition_overwrite": store_partition_overwrite,
    "store_unpartitioned": store_unpartitioned,
    "store_file_control": store_file_control,
    "store_catalog": store_catalog,
    "store_optional_inputs": store_optional_inputs,
    "store_required_input": store_required_input,
    "export_csv": export_csv_report,
    "clean_names": clean_names,
    "clean_empty_to_null": clean_empty_to_null,
    "clean_cast_contract": clean_cast_contract,
    "clean_guarded_cast": clean_guarded_cast,
    "decode_codes": decode_codes,
    "json_payload": json_payload,
    "dedup_by_key": dedup_by_key,
    "dedup_null_keys": dedup_null_keys,
    "dedup_audit": dedup_audit_query,
    "dim_load": dim_load,
    "enrich_state": enrich_state,
    "enrich_hierarchy": enrich_hierarchy,
    "join_coverage": join_coverage,
    "join_orphans": join_orphans,
    "metrics_by_group": metrics_by_group,
    "metrics_composite": metrics_composite,
    "metrics_ratios": metrics_ratios,
    "metrics_mean": metrics_mean,
    "metrics_weighted": metrics_weighted,
    "metrics_weighted_small": metrics_weighted_small,
    "metrics_mean_large": metrics_mean_large,
    "mean_of_groups": mean_of_groups,
    "target_of_year": target_of_year_query,
    "target_status": target_status_query,
    "target_gap": target_gap,
    "unified_table": unified_table,
    **REPORTS,
    "report_top_results": report_top_results,
    "quality_report": quality_report_query,
    "quality_report_targets": quality_report_targets,
    "quality_null_count": quality_null_count,
    "quality_duplicate_keys": quality_duplicate_keys,
    "quality_rows_vs_ids": quality_rows_vs_ids,
    "quality_code_pairs": quality_code_pairs,
    "quality_status_distribution": quality_status_distribution,
    "quality_status_by_year": quality_status_by_year,
    "quality_row_counts": quality_row_counts,
    "quality_checks": quality_checks,
    "quality_checks_absent": quality_checks_absent,
    "stream_ingest": stream_ingest,
    "stream_replay": stream_replay,
    "stream_quarantine": stream_quarantine,
    "stream_empty_batch": stream_empty_batch,
    "stream_lifecycle": stream_lifecycle,
    "layered_run": layered_run,
}
