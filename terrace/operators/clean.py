"""Conforming a raw table to its contract. Each operator is one projection."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.contracts import CodeList, EntityContract, PayloadSpec
from terrace.functions.numbers import whole_number
from terrace.functions.text import blank_to_null, snake_name


def standard_names(df: DataFrame) -> DataFrame:
    """Columns renamed to snake case; two that end up with one name are an error."""
    names = [snake_name(c) for c in df.columns]
    clashes = [n for n, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"columns share a name after renaming: {clashes}")
    return df.toDF(*names)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Text trimmed, empty text null; technical columns (leading underscore) untouched."""
    changed = {
        f.name: blank_to_null(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")
    }
    return df.withColumns(changed) if changed else df


def cast_by_contract(df: DataFrame, contract: EntityContract) -> DataFrame:
    """Contract types for the columns that are there; a value that does not fit is null."""
    types: dict[str, str] = {}
    for column in df.columns:
        if column in contract.texts:
            types[column] = "string"
        elif column in contract.integers:
            types[column] = "int"
        elif column in contract.doubles or column.startswith(contract.double_prefixes):
            types[column] = "double"
    current = dict(df.dtypes)
    changed = {c: _as(F.col(c), current[c], t) for c, t in types.items() if current[c] != t}
    return df.withColumns(changed) if changed else df


def _as(column: Column, current: str, wanted: str) -> Column:
    if current == "string" and wanted == "int":
        return whole_number(column)
    return column.try_cast(wanted)


def typed_value(column: str, kind: str) -> Column:
    """Text as the type it arrives as; null if it is empty or does not fit."""
    text = F.nullif(F.col(column), F.lit(""))
    return whole_number(text) if kind == "int" else text.try_cast(kind)


def type_payload(df: DataFrame, spec: PayloadSpec) -> DataFrame:
    """Arrival types of a streamed record: empty text is null, then the typed cast."""
    return df.withColumns({c: typed_value(c, kind) for c, kind in spec.typed})


def decode(df: DataFrame, codes: CodeList) -> DataFrame:
    """Label next to a code; an unknown code, or text already, is its own label."""
    if codes.column not in df.columns:
        return df
    labels = F.create_map(*[F.lit(v) for pair in codes.labels for v in pair])
    code = F.col(codes.column)
    return df.withColumn(codes.label_column, F.coalesce(labels[code], code))
