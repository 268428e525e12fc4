"""Declarations that drive the operators: what a table holds, never how to run it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class CodeList:
    """Labels of a coded column, kept in a second column next to the code."""

    column: str
    label_column: str
    labels: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class EntityContract:
    """One entity: its columns, its grain and how it is stored.

    ``compact`` asks for few files per partition (small tables); without it the
    writing tasks keep the parallelism they have.
    """

    name: str
    keys: tuple[str, ...]
    integers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    double_prefixes: tuple[str, ...] = ()
    critical: tuple[str, ...] = ()
    dimension: str | None = None
    codes: tuple[CodeList, ...] = ()
    compact: bool = False
    partition_by: tuple[str, ...] = ("ano",)
    source_file: str | None = None
    source_schema: T.StructType | None = None


@dataclass(frozen=True)
class Dimension:
    """A reference table: ``columns`` maps source names to names in the library."""

    name: str
    key: str
    columns: tuple[tuple[str, str], ...]
    source_file: str | None = None


@dataclass(frozen=True)
class CompositeGroup:
    """A group made of other groups; no ``members`` means every group."""

    code: str
    members: tuple[str, ...] | None = None


@dataclass(frozen=True)
class MetricColumns:
    """Where the group metrics find their inputs in the fact table."""

    groups: tuple[str, ...]
    network: str
    present: str
    success: str
    score: str
    weight: str


@dataclass(frozen=True)
class StatusSpec:
    """One target-status column: ``value`` is judged against ``target``."""

    flag: str
    value: str
    target: str


@dataclass(frozen=True)
class PayloadSpec:
    """A streamed record: text fields as sent, and the types some of them get on arrival."""

    fields: tuple[str, ...]
    typed: tuple[tuple[str, str], ...] = ()
    partition_by: str = "ano"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.fields])


@dataclass(frozen=True)
class Slice:
    """What a report looks at. Unset parts do not filter."""

    year: int | None = None
    network: str | None = None
    region: str | None = None
    state: str | None = None
    grade: str | None = None
    columns: dict[str, str] = field(
        default_factory=lambda: {
            "year": "ano",
            "network": "rede",
            "region": "nome_regiao",
            "state": "sigla_uf",
            "grade": "serie",
        }
    )
