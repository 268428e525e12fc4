"""Quality figures as tables, so that they can be stored, compared and tested."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.contracts import EntityContract
from terrace.functions.numbers import percent


def _line(metric: str, subject: Column, n: Column, of: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        subject.cast("string").alias("subject"),
        n.alias("n"),
        of.alias("of"),
    )


def quality_report(
    df: DataFrame, entity: str, critical: Sequence[str], year: str = "ano"
) -> DataFrame:
    """Rows, rows per year present, and nulls of the critical columns, one figure per row.

    One scan and one aggregate by year; the rest works on one row per year. ``warning``
    marks a critical column that has nulls.
    """
    columns = [c for c in critical if c in df.columns]
    by_year = F.col(year) if year in df.columns else F.lit(None).cast("int")
    yearly = df.groupBy(by_year.alias("_year")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
    )
    rows = F.col("_rows")
    lines = [
        _line("rows", F.lit(None), rows, rows),
        _line("year", F.col("_year"), rows, rows),
        *[_line("nulls", F.lit(c), F.col(f"_null_{c}"), rows) for c in columns],
    ]
    totals = (
        yearly.select(F.explode(F.array(*lines)).alias("line"))
        .select("line.*")
        .filter((F.col("metric") != "year") | F.col("subject").isNotNull())
        .groupBy("metric", "subject")
        .agg(F.sum("n").alias("n"), F.sum("of").alias("of"))
    )
    is_null_line = F.col("metric") == "nulls"
    return totals.select(
        F.lit(entity).alias("entity"),
        "metric",
        "subject",
        "n",
        F.when(is_null_line, percent(F.col("n"), F.col("of"))).alias("pct"),
        (is_null_line & (F.col("n") > 0)).alias("warning"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def rows_and_ids(df: DataFrame, id_column: str, approximate: bool = False) -> DataFrame:
    """Rows against distinct ids; fewer ids than rows means repeated records.

    ``approximate`` trades the exact distinct count for a sketch that needs no second
    shuffle.
    """
    ids = F.approx_count_distinct(id_column) if approximate else F.count_distinct(id_column)
    return df.agg(F.count(F.lit(1)).alias("registros"), ids.alias("ids_distintos"))


def null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("nulls"))


def code_pairs(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of codes and labels, to check the decoding."""
    return df.select(*columns).distinct().orderBy(*columns)


def status_distribution(df: DataFrame, status: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, status).agg(F.count(F.lit(1)).alias("qtd"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("entity"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_checks(df: DataFrame, contract: EntityContract) -> DataFrame:
    """Expectations on one table: it has rows, a unique key, no orphans, no critical nulls.

    Nulls in the data are a warning, everything else is an error of the run.

    The table is read once and reduced to one row per key before the figures are added
    up. An orphan is a row without the columns its dimension should have given it.
    """
    keys = [k for k in contract.keys if k in df.columns]
    watched = {f"nulls in {c}": F.col(c) for c in contract.critical if c in df.columns}
    if contract.dimension and "nome_uf" in df.columns:
        watched[f"rows without {contract.dimension}"] = F.col("nome_uf")
    names = list(watched)
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(c.isNull()).alias(f"_n{i}") for i, c in enumerate(watched.values())],
    )
    totals = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        F.count_if(F.col("_rows") > 1).alias("_repeated"),
        *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_n{i}") for i in range(len(names))],
    )

    def check(name: str, found: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.lit("warning" if name.startswith("nulls in") else "error").alias("level"),
            found.alias("found"),
            passed.alias("passed"),
        )

    checks = [
        check("has rows", F.col("_rows"), F.col("_rows") > 0),
        check("repeated keys", F.col("_repeated"), F.col("_repeated") == 0),
        *[check(n, F.col(f"_n{i}"), F.col(f"_n{i}") == 0) for i, n in enumerate(names)],
    ]
    return totals.select(F.explode(F.array(*checks)).alias("c")).select(
        F.lit(contract.name).alias("entity"), "c.*"
    )
