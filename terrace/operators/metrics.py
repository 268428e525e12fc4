"""Group metrics of a person-level fact, for groups that may overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.contracts import CompositeGroup, MetricColumns
from terrace.functions.numbers import (
    exact_mean,
    exact_sum,
    exact_sum_of_products,
    finite,
    half_up_quotient,
    inexact,
    percent,
)

SUMS = (
    "alunos_total",
    "alunos_presentes",
    "alunos_alfabetizados",
    "soma_proficiencia",
    "n_proficiencia",
    "soma_proficiencia_peso",
    "soma_peso",
    "n_inexatos",
    "dupla_proficiencia",
    "dupla_proficiencia_peso",
    "dupla_peso",
)


def group_sums(facts: DataFrame, columns: MetricColumns) -> DataFrame:
    """Mergeable sums per group and network: counts, exact decimal sums and sums of doubles.

    Success counts among those present only. A weight counts where there is a score.
    ``n_inexatos`` counts the rows that the decimal sums do not hold exactly: scores with
    more than four decimals, weights with more than two, and very large ones.
    """
    present = F.col(columns.present)
    score = F.col(columns.score)
    weight = F.col(columns.weight)
    scored = finite(score).isNotNull()
    weighed = F.when(scored, finite(weight))
    beyond = inexact(score, 4, 1e9) | F.coalesce(inexact(weighed, 2, 1e9), F.lit(False))
    return facts.groupBy(*columns.groups, columns.network).agg(
        F.count(F.lit(1)).alias("alunos_total"),
        F.sum(present).cast("bigint").alias("alunos_presentes"),
        F.sum(F.when(present == 1, F.col(columns.success)).otherwise(0))
        .cast("bigint")
        .alias("alunos_alfabetizados"),
        exact_sum(score).alias("soma_proficiencia"),
        F.count_if(scored).alias("n_proficiencia"),
        exact_sum_of_products(score, weight).alias("soma_proficiencia_peso"),
        exact_sum(weighed).alias("soma_peso"),
        F.count_if(beyond).alias("n_inexatos"),
        F.sum(finite(score)).alias("dupla_proficiencia"),
        F.sum(finite(score) * weighed).alias("dupla_proficiencia_peso"),
        F.sum(weighed).alias("dupla_peso"),
    )


def memberships(network: Column, composites: Sequence[CompositeGroup]) -> Column:
    """Array of the groups a network belongs to: itself and the composites it is part of."""
    clash = network.isin([c.code for c in composites])
    own = F.when(
        clash, F.raise_error(F.concat(F.lit("network code is a composite code: "), network))
    ).otherwise(network)
    parts = [F.array(own)]
    for composite in composites:
        code = F.array(F.lit(composite.code))
        if composite.members is None:
            parts.append(code)
        else:
            member = F.coalesce(network.isin(list(composite.members)), F.lit(False))
            parts.append(F.when(member, code).otherwise(F.array().cast("array<string>")))
    return F.concat(*parts)


def with_composites(
    sums: DataFrame, columns: MetricColumns, composites: Sequence[CompositeGroup]
) -> DataFrame:
    """Add the composite groups to the base groups.

    The fact was aggregated once, to the base networks. Only those few rows are copied
    into the groups they belong to and summed again, so the second shuffle carries
    groups and not people.
    """
    if not composites:
        return sums
    spread = sums.withColumn(
        columns.network, F.explode(memberships(F.col(columns.network), composites))
    )
    return spread.groupBy(*columns.groups, columns.network).agg(
        *[F.sum(c).cast(dict(sums.dtypes)[c]).alias(c) for c in SUMS]
    )


def _mean(total: str, whole: str, whole_as_double: str) -> Column:
    """From the decimal sums where they are exact, else from those of doubles."""
    exact = half_up_quotient(F.col(f"soma_{total}"), F.col(whole))
    parts = F.col(f"dupla_{total}") / F.when(F.col(whole_as_double) > 0, F.col(whole_as_double))
    return F.when(F.col("n_inexatos") == 0, exact).otherwise(F.round(parts, 2))


def rates_and_means(sums: DataFrame) -> DataFrame:
    """Attendance and success percentages, mean and weighted mean, after the last sum."""
    return sums.withColumns(
        {
            "proporcao_presenca": percent(F.col("alunos_presentes"), F.col("alunos_total")),
            "taxa_alfabetizacao_observada": percent(
                F.col("alunos_alfabetizados"), F.col("alunos_presentes")
            ),
            "proficiencia_media": _mean("proficiencia", "n_proficiencia", "n_proficiencia"),
            "proficiencia_media_ponderada": _mean("proficiencia_peso", "soma_peso", "dupla_peso"),
        }
    )


def student_metrics(
    facts: DataFrame,
    columns: MetricColumns,
    composites: Sequence[CompositeGroup] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """All metrics per group, for the networks in the data and the composites over them.

    ``keep`` names sums to keep, as doubles, from which means over groups can be made.
    """
    metrics = rates_and_means(with_composites(group_sums(facts, columns), columns, composites))
    kept = {
        c: F.when(F.col("n_inexatos") == 0, F.col(c).cast("double")).otherwise(
            F.col(c.replace("soma_", "dupla_"))
        )
        for c in keep
    }
    return metrics.withColumns(kept).drop(*[c for c in SUMS[3:] if c not in keep])


def weighted_mean(total: str, weight: str, places: int = 2) -> Column:
    """Aggregate: the weighted mean over groups, from their sums of products and of weights."""
    exact = half_up_quotient(exact_sum(F.col(total)), exact_sum(F.col(weight)), places)
    whole = F.sum(F.col(weight))
    as_doubles = F.round(F.sum(F.col(total)) / F.when(whole > 0, whole), places)
    beyond = F.coalesce(inexact(F.col(total)) | inexact(F.col(weight)), F.lit(False))
    return F.when(F.count_if(beyond) == 0, exact).otherwise(as_doubles)


def mean_of_groups(
    groups: DataFrame, keys: Sequence[str], measures: dict[str, str], places: int = 2
) -> DataFrame:
    """Unweighted mean over group rows: ``measures`` maps a column to its output name."""
    return groups.groupBy(*keys).agg(
        *[exact_mean(F.col(c), places).alias(name) for c, name in measures.items()]
    )
