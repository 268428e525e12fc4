"""The literacy entities, derived from a star schema of orders and suppliers.

A line item stands for a student, its supplier for a municipality, nation and region
for state and region. The return flag is the network (A, N, R, with the composites P =
A + N and T = all), the line status is the grade, the ship year is the year.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.contracts import CodeList, CompositeGroup
from terrace.functions.numbers import exact_sum, half_up_quotient, percent
from terrace.operators.clean import decode
from terrace.operators.metrics import memberships
from terrace.plans import literacy as L
from terrace.plans.analytical import analytical_table
from terrace.sources.layers import read_if_present, write_layer
from terrace.sources.scratch import scratch_path

COMPOSITES = (CompositeGroup("P", ("A", "N")), CompositeGroup("T"))
CODES = (
    CodeList(
        "rede",
        "rede_nome",
        (("A", "Accepted"), ("R", "Returned"), ("P", "Accepted or N"), ("T", "Total")),
    ),
    CodeList("serie", "serie_nome", (("O", "Open"), ("F", "Final"))),
)
TARGET_YEARS = (1996, 1997, 1998)
CONTRACTS = tuple(replace(c, codes=CODES) for c in (*L.published(TARGET_YEARS), L.STUDENTS))

_written: dict[tuple[object, ...], str] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source_version(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Number and hash of the files of the tables used here: paths, sizes and times."""
    tables = ("lineitem", "supplier", "nation", "region")
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in tables])
    found = files.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
    )
    return tuple(found.first())


def written_once(
    spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A table in the shared scratch folder, built on first use in the application.

    It is built anew if the files that it is derived from are others by then. Its rows come
    out of an aggregate or a join, in few tasks; they are written as they lie, since
    grouping them by year would shuffle each of these tables once more as a whole.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label, source_version(spark, sf_dir))
    if key in _written:
        found = read_if_present(spark, _written[key])
        if found is not None:
            return found
    path = scratch_path(spark, label)
    write_layer(build(), path)
    _written[key] = path
    return spark.read.parquet(path)


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a student record; the seventh line of an order is absent."""
    present = F.col("l_linenumber") <= 6
    return load(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ano"),
        F.col("l_suppkey").cast("string").alias("id_municipio"),
        F.col("l_linenumber").cast("string").alias("id_escola"),
        F.col("l_orderkey").cast("string").alias("id_aluno"),
        F.col("l_partkey").cast("string").alias("caderno"),
        F.col("l_linestatus").alias("serie"),
        F.col("l_returnflag").alias("rede"),
        present.cast("int").alias("presenca"),
        F.when(present, F.lit(1.0)).alias("preenchimento_caderno"),
        (present & (F.col("l_quantity") >= 25)).cast("int").alias("alfabetizado"),
        F.when(present, F.col("l_extendedprice")).alias("proficiencia"),
        F.when(present, F.col("l_quantity")).alias("peso_aluno"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality, state and region of each supplier, and the number of its nation."""
    nation = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return (
        load(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("s_suppkey").cast("string").alias("id_municipio"),
            F.col("s_name").alias("nome_municipio"),
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("sigla_uf"),
            F.col("n_name").alias("nome_uf"),
            F.col("r_name").alias("nome_regiao"),
            F.col("n_nationkey").alias("number"),
        )
    )


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums that the published tables derive from, one row per municipality, grade and network."""
    return (
        load(spark, sf_dir, "lineitem")
        .groupBy(
            F.year("l_shipdate").alias("ano"),
            F.col("l_suppkey").cast("string").alias("id_municipio"),
            F.col("l_linestatus").alias("serie"),
            F.col("l_returnflag").alias("rede"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("l_quantity") >= 25).alias("high"),
            exact_sum(F.col("l_extendedprice")).alias("price"),
        )
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_once(spark, sf_dir, "cells", lambda: _cells(spark, sf_dir))


def _result(sums: DataFrame, grain: list[str]) -> DataFrame:
    """Rate and mean per group; some states publish no rate."""
    spread = sums.withColumn("rede", F.explode(memberships(F.col("rede"), COMPOSITES)))
    totals = spread.groupBy(*grain, "number").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("price").alias("price")
    )
    published = F.col("number") % 13 != 0
    return totals.select(
        *grain,
        F.when(published, percent(F.col("high"), F.col("n"))).alias("taxa_alfabetizacao"),
        half_up_quotient(F.col("price"), F.col("n"), 4).alias("media_portugues"),
        *[F.lit(None).cast("double").alias(f"{L.LEVEL_PREFIX}{n}") for n in L.LEVELS],
    )


def _targets(place_years: DataFrame, base: int, cycle: int, rate: F.Column) -> DataFrame:
    """Wide target table: one column per year; every ``cycle``-th state has no target."""
    number = F.col("number")
    target = F.when(number % cycle != 0, (number % cycle + base).cast("double"))
    return place_years.select(
        *[c for c in place_years.columns if c not in ("number", "n", "high")],
        F.lit("Pública").alias("rede"),
        rate.alias("taxa_alfabetizacao"),
        *[(target + F.lit(y - 1996)).alias(f"{L.TARGET_PREFIX}{y}") for y in TARGET_YEARS],
        F.when(number % 6 != 0, (number % 5 + 83).cast("double")).alias("percentual_participacao"),
    )


def published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five published tables as loaded, so that the planner knows how large they are."""
    lazily = _published(spark, sf_dir)
    return {
        name: written_once(spark, sf_dir, name, build) for name, build in lazily.items()
    }


def _published(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    rate = percent(F.col("high"), F.col("n"))

    def located() -> DataFrame:
        where = places(spark, sf_dir).select("id_municipio", "sigla_uf", "number")
        return cells(spark, sf_dir).join(where, "id_municipio", "left")

    def totals(*keys: str) -> DataFrame:
        return located().groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("high").alias("high"))

    return {
        L.MUNICIPAL_RESULT: lambda: _result(located(), ["ano", "id_municipio", "serie", "rede"]),
        L.STATE_RESULT: lambda: _result(located(), ["ano", "sigla_uf", "serie", "rede"]),
        L.MUNICIPAL_TARGET: lambda: _targets(
            totals("ano", "id_municipio", "number"), 49, 7, rate
        ).withColumn("nivel_alfabetizacao", F.lit(3)),
        L.STATE_TARGET: lambda: _targets(totals("ano", "sigla_uf", "number"), 50, 4, rate),
        L.NATIONAL_TARGET: lambda: _targets(
            totals("ano").withColumn("number", F.lit(1)), 50, 2, rate
        ),
    }


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    municipal = published(spark, sf_dir)[L.MUNICIPAL_RESULT]
    for codes in CODES:
        municipal = decode(municipal, codes)
    return municipal.join(places(spark, sf_dir).drop("number"), "id_municipio", "left")


def conformed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What the analytical table needs, decoded and with descriptive columns."""
    described = written_once(
        spark, sf_dir, "conformed_municipal", lambda: _described(spark, sf_dir)
    )
    return {
        **published(spark, sf_dir),
        L.MUNICIPAL_RESULT: described,
        L.STUDENT: students(spark, sf_dir),
    }


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytical_table(conformed(spark, sf_dir), COMPOSITES)


def stored_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytical table as reports read it: stored by year."""
    return written_once(spark, sf_dir, "analytical", lambda: unified(spark, sf_dir))
