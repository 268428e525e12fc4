"""The analytical table: every municipal result with all that is known about it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.contracts import CompositeGroup, StatusSpec
from terrace.functions.targets import target_of_year, target_status
from terrace.operators.joins import add_columns
from terrace.operators.metrics import mean_of_groups, student_metrics
from terrace.plans import literacy as L

GRAIN = ("ano", "id_municipio", "serie", "rede")
MEASURES = ("taxa_alfabetizacao", "media_portugues")


def add_statuses(df: DataFrame, specs: Sequence[StatusSpec]) -> DataFrame:
    """Status columns for the pairs of value and target that the table has."""
    possible = {
        s.flag: target_status(F.col(s.value), F.col(s.target))
        for s in specs
        if s.value in df.columns and s.target in df.columns
    }
    return df.withColumns(possible) if possible else df


def targets_for(table: DataFrame | None, scale: str, place: Sequence[str]) -> DataFrame | None:
    """Target and expected participation of the row's own year, per year and place."""
    if table is None:
        return None
    picked = [
        target_of_year(table.columns, L.TARGET_PREFIX, F.col("ano")).alias(
            f"meta_alfabetizacao_{scale}"
        ),
        F.col("percentual_participacao").alias(f"percentual_participacao_{scale}"),
    ]
    if scale == "brasil":
        picked.append(F.col("taxa_alfabetizacao").alias("taxa_alfabetizacao_brasil_oficial"))
    return table.select("ano", *place, *picked)


def analytical_table(
    tables: Mapping[str, DataFrame],
    composites: Sequence[CompositeGroup] = L.COMPOSITES,
) -> DataFrame:
    """Join results, student metrics, means and targets at the grain of the municipal result.

    The municipal and state results must be there. Every other table is optional, and
    what depends on an absent one is left out of the columns. A left join per table
    keeps exactly the rows of the municipal result; a right side with a repeated key
    stops the query.
    """
    state = tables[L.STATE_RESULT]
    descriptive = ("nome_municipio", "sigla_uf", "nome_uf", "nome_regiao")
    table = tables[L.MUNICIPAL_RESULT].select(
        *GRAIN,
        *descriptive,
        "serie_nome",
        "rede_nome",
        *[F.col(m).alias(f"{m}_municipio") for m in MEASURES],
    )

    state_grain = ("ano", "sigla_uf", "serie", "rede")
    state_view = state.select(*state_grain, *[F.col(m).alias(f"{m}_uf") for m in MEASURES])
    table = add_columns(table, state_view, state_grain, L.STATE_RESULT)

    national_grain = ("ano", "serie", "rede")
    national = mean_of_groups(state, national_grain, {m: f"{m}_brasil" for m in MEASURES})
    table = table.join(national, on=list(national_grain), how="left")

    for entity, scale, place in (
        (L.MUNICIPAL_TARGET, "municipio", ("id_municipio",)),
        (L.STATE_TARGET, "uf", ("sigla_uf",)),
        (L.NATIONAL_TARGET, "brasil", ()),
    ):
        targets = targets_for(tables.get(entity), scale, place)
        table = add_columns(table, targets, ("ano", *place), entity)

    # Last, since these are the widest columns: a join with large targets shuffles the table.
    students = tables.get(L.STUDENT)
    if students is not None:
        metrics = student_metrics(students, L.STUDENT_METRICS, composites, L.SLICE_SUMS)
        table = table.join(metrics, on=list(GRAIN), how="left")

    table = add_statuses(table, L.STATUSES)
    return table.select([c for c in (*L.ANALYTICAL_COLUMNS, *L.SLICE_SUMS) if c in table.columns])
