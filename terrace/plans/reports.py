"""Report queries on the analytical table. Each takes the table and a slice, and returns rows.

Sorting always ends with a key, so that a limit cuts at the same place on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.contracts import Slice
from terrace.functions.numbers import bin_start, exact_mean, percent
from terrace.functions.slices import apply_slice
from terrace.functions.targets import (
    BELOW,
    MET,
    NO_DATA,
    NO_TARGET,
    gap_to_target,
    status_rank,
)
from terrace.functions.text import contains_text, place_label
from terrace.operators.compare import change_from_previous_year, share_of_group
from terrace.operators.metrics import weighted_mean
from terrace.plans.literacy import CUT_SCORE, SLICE_SUMS
from terrace.sources.catalog import has_columns

STUDENT_COLUMNS = ("alunos_total", "alunos_presentes", "alunos_alfabetizados", "proporcao_presenca")


def years_and_networks(table: DataFrame) -> DataFrame:
    """Years and networks to choose from, newest year first."""
    return table.select("ano", "rede", "rede_nome").distinct().orderBy(F.desc("ano"), "rede")


def territories(table: DataFrame, region: str | None = None) -> DataFrame:
    """Regions and states to choose from; with a region, only its states."""
    chosen = apply_slice(table, Slice(region=region))
    columns = ("nome_regiao", "sigla_uf", "nome_uf")
    return chosen.select(*columns).distinct().orderBy("nome_regiao", "sigla_uf")


def country_by_year(table: DataFrame) -> DataFrame:
    """Official national rate, target and participation; each is the same in all rows of a year."""
    return (
        table.groupBy("ano")
        .agg(
            F.max("taxa_alfabetizacao_brasil_oficial").alias("taxa_oficial"),
            F.max("meta_alfabetizacao_brasil").alias("meta_nacional"),
            F.max("percentual_participacao_brasil").alias("participacao"),
        )
        .orderBy("ano")
    )


def country_change(table: DataFrame) -> DataFrame:
    """National rate with its change from the year before and its distance to the target."""
    changed = change_from_previous_year(country_by_year(table), (), "ano", "taxa_oficial", "delta")
    gap = gap_to_target(F.col("taxa_oficial"), F.col("meta_nacional"))
    return changed.withColumn("gap", gap).orderBy("ano")


def slice_kpis(table: DataFrame, wanted: Slice) -> DataFrame:
    """Municipalities, mean rate, and how many met their target, of those that have one."""
    status = F.col("meta_atingida_municipio")
    return (
        apply_slice(table, wanted)
        .agg(
            F.count_distinct("id_municipio").alias("municipios"),
            exact_mean(F.col("taxa_alfabetizacao_municipio")).alias("taxa_media"),
            F.count_if(status == MET).alias("atingiram"),
            F.count_if(status == BELOW).alias("abaixo"),
            F.count_if(status == NO_TARGET).alias("sem_meta"),
            F.count_if(status == NO_DATA).alias("sem_dado"),
        )
        .withColumn("com_meta", F.col("atingiram") + F.col("abaixo"))
        .withColumn(
            "pct_atingiu",
            F.when(F.col("com_meta") > 0, F.col("atingiram") / F.col("com_meta") * 100),
        )
    )


def state_ranking(table: DataFrame, wanted: Slice) -> DataFrame:
    """States by rate, highest first, with target and status."""
    return (
        apply_slice(table, wanted)
        .filter(F.col("taxa_alfabetizacao_uf").isNotNull())
        .groupBy("sigla_uf")
        .agg(
            F.max("nome_uf").alias("nome_uf"),
            F.max("taxa_alfabetizacao_uf").alias("taxa_uf"),
            F.max("meta_alfabetizacao_uf").alias("meta_uf"),
            F.max("meta_atingida_uf").alias("status_meta"),
        )
        .orderBy(F.desc("taxa_uf"), "sigla_uf")
    )


def rate_histogram(table: DataFrame, wanted: Slice, width: int = 5) -> DataFrame:
    """Municipalities per bin of the rate, from ``faixa`` up to, not including, ``faixa_fim``."""
    rate = F.col("taxa_alfabetizacao_municipio")
    return (
        apply_slice(table, wanted)
        .filter(rate.isNotNull())
        .groupBy(bin_start(rate, width).alias("faixa"))
        .agg(F.count(F.lit(1)).alias("municipios"))
        .withColumn("faixa_fim", F.col("faixa") + F.lit(width))
        .orderBy("faixa")
    )


def status_by_region(table: DataFrame, wanted: Slice) -> DataFrame:
    """Municipalities per region and status, and their share of the region."""
    counted = (
        apply_slice(table, wanted)
        .groupBy("nome_regiao", F.col("meta_atingida_municipio").alias("status_meta"))
        .agg(F.count(F.lit(1)).alias("municipios"))
    )
    shares = share_of_group(counted, ["nome_regiao"], "municipios", "pct")
    return shares.orderBy("nome_regiao", status_rank(F.col("status_meta")))


def extremes(table: DataFrame, wanted: Slice, highest: bool = True, n: int = 10) -> DataFrame:
    """The n municipalities with the highest, or lowest, rate."""
    rate = F.col("taxa_alfabetizacao_municipio")
    return (
        apply_slice(table, wanted)
        .filter(rate.isNotNull())
        .orderBy(rate.desc() if highest else rate.asc(), "id_municipio")
        .limit(n)
        .select(
            "nome_municipio",
            "sigla_uf",
            rate.alias("taxa"),
            F.col("meta_alfabetizacao_municipio").alias("meta"),
            F.col("meta_atingida_municipio").alias("status_meta"),
            place_label(F.col("nome_municipio"), F.col("sigla_uf")).alias("rotulo"),
        )
    )


def top_results(results: DataFrame, year: int, n: int = 10) -> DataFrame:
    """The n highest published rates of a year, from a result table of any layer."""
    place = "sigla_uf" if "sigla_uf" in results.columns else "id_municipio"
    return (
        apply_slice(results, Slice(year=year))
        .orderBy(F.desc("taxa_alfabetizacao"), place, "serie", "rede")
        .limit(n)
        .select("ano", place, "rede", "taxa_alfabetizacao", "media_portugues")
    )


def student_kpis(table: DataFrame, wanted: Slice, cut: float = CUT_SCORE) -> DataFrame:
    """Students, attendance, observed rate, and two mean scores.

    ``proficiencia_media`` is the unweighted mean of the groups' weighted means and
    ``vs_corte`` its distance to the cut score. ``proficiencia_media_ponderada`` is the mean
    over the students of the slice, each with its weight.
    """
    return (
        apply_slice(table, wanted)
        .agg(
            *[F.sum(c).alias(c) for c in STUDENT_COLUMNS[:3]],
            exact_mean(F.col("proficiencia_media_ponderada")).alias("proficiencia_media"),
            weighted_mean(*SLICE_SUMS).alias("proficiencia_media_ponderada"),
        )
        .select(
            *STUDENT_COLUMNS[:3],
            percent(F.col("alunos_presentes"), F.col("alunos_total")).alias("presenca_media"),
            percent(F.col("alunos_alfabetizados"), F.col("alunos_presentes")).alias(
                "taxa_observada"
            ),
            "proficiencia_media",
            "proficiencia_media_ponderada",
            (F.col("proficiencia_media") - F.lit(cut)).alias("vs_corte"),
        )
    )


def attendance_and_rate(table: DataFrame, wanted: Slice, limit: int | None = None) -> DataFrame:
    """One point per row with student data: attendance against observed rate."""
    points = (
        apply_slice(table, wanted)
        .filter(F.col("proporcao_presenca").isNotNull())
        .orderBy("id_municipio", *_rest_of_grain(table))
    )
    chosen = points if limit is None else points.limit(limit)
    return chosen.select(
        "nome_municipio",
        "sigla_uf",
        "proporcao_presenca",
        "taxa_alfabetizacao_observada",
        F.col("meta_atingida_municipio").alias("status_meta"),
        F.col("meta_atingida_presenca_municipio").alias("status_presenca"),
    )


def _rest_of_grain(table: DataFrame) -> list[str]:
    return [c for c in ("ano", "serie", "rede") if c in table.columns]


def status_crosstab(table: DataFrame, wanted: Slice) -> DataFrame:
    """Municipalities by target status and attendance status."""
    return (
        apply_slice(table, wanted)
        .groupBy(
            F.col("meta_atingida_municipio").alias("status_meta"),
            F.col("meta_atingida_presenca_municipio").alias("status_presenca"),
        )
        .agg(F.count(F.lit(1)).alias("municipios"))
    )


# Why a municipality is below its target.
LEARNING = "Aprendizagem (presença OK)"
PARTICIPATION = "Participação + aprendizagem"
NO_REFERENCE = "Sem referência de presença"


def below_target_diagnosis(table: DataFrame, wanted: Slice) -> DataFrame:
    """Municipalities below target by what holds them back; a cause without any counts zero."""
    attendance = F.col("meta_atingida_presenca_municipio")
    below = apply_slice(table, wanted).filter(F.col("meta_atingida_municipio") == BELOW)
    counts = below.agg(
        F.count_if(attendance == MET).alias("ok"),
        F.count_if(attendance == BELOW).alias("low"),
        F.count_if(attendance.isNull() | ~attendance.isin(MET, BELOW)).alias("unknown"),
    )
    buckets = F.array(
        *[
            F.struct(F.lit(label).alias("diagnostico"), F.col(c).alias("municipios"))
            for label, c in ((LEARNING, "ok"), (PARTICIPATION, "low"), (NO_REFERENCE, "unknown"))
        ]
    )
    return counts.select(F.inline(buckets))


# The columns of the detail table.
DETAIL_COLUMNS = (
    "id_municipio", "nome_municipio", "sigla_uf", "nome_regiao", "rede_nome",
    "taxa_alfabetizacao_municipio", "meta_alfabetizacao_municipio", "meta_atingida_municipio",
    "media_portugues_municipio", "percentual_participacao_municipio",
    "taxa_alfabetizacao_uf", "taxa_alfabetizacao_brasil_oficial",
)


def detail(
    table: DataFrame, wanted: Slice, search: str = "", limit: int | None = None
) -> DataFrame:
    """Municipality by municipality, highest rate first, optionally searched by name."""
    rows = apply_slice(table, wanted)
    if search:
        rows = rows.filter(contains_text(F.col("nome_municipio"), search))
    ordered = rows.orderBy(
        F.desc("taxa_alfabetizacao_municipio"), "id_municipio", *_rest_of_grain(table)
    )
    return (ordered if limit is None else ordered.limit(limit)).select(*DETAIL_COLUMNS)


def student_section(table: DataFrame, wanted: Slice) -> dict[str, DataFrame]:
    """The reports that need student data; none for a table built without it."""
    if not has_columns(table, *STUDENT_COLUMNS, *SLICE_SUMS):
        return {}
    return {
        "student_kpis": student_kpis(table, wanted),
        "attendance_and_rate": attendance_and_rate(table, wanted),
        "status_crosstab": status_crosstab(table, wanted),
        "below_target_diagnosis": below_target_diagnosis(table, wanted),
    }
