"""The literacy assessment: its six entities, two dimensions and code lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from terrace.contracts import (
    CodeList,
    CompositeGroup,
    Dimension,
    EntityContract,
    MetricColumns,
    PayloadSpec,
    StatusSpec,
)

# Entity names, column prefixes and the cut score of the assessment.
STATE_RESULT = "avaliacao_alfabetizacao_uf"
MUNICIPAL_RESULT = "avaliacao_alfabetizacao_municipio"
NATIONAL_TARGET = "avaliacao_alfabetizacao_meta_alfabetizacao_brasil"
STATE_TARGET = "avaliacao_alfabetizacao_meta_alfabetizacao_uf"
MUNICIPAL_TARGET = "avaliacao_alfabetizacao_meta_alfabetizacao_municipio"
STUDENT = "avaliacao_alfabetizacao_aluno"
ANALYTICAL = "alfabetizacao_analise_output"
SOURCE_PREFIX = "br_inep_"
LEVEL_PREFIX = "proporcao_aluno_nivel_"
TARGET_PREFIX = "meta_alfabetizacao_"
LEVELS = range(0, 9)
TARGET_YEARS = range(2024, 2031)
CUT_SCORE = 743.0

# Labels of the network and grade codes.
NETWORKS = CodeList(
    "rede",
    "rede_nome",
    (
        ("0", "Total (Federal, Estadual, Municipal e Privada)"),
        ("1", "Federal"),
        ("2", "Estadual"),
        ("3", "Municipal"),
        ("4", "Privada"),
        ("5", "Pública (Estadual e Municipal)"),
        ("6", "Pública (Federal, Estadual e Municipal)"),
    ),
)
GRADES = CodeList("serie", "serie_nome", (("2", "2º ano do Ensino Fundamental"),))

# Networks derived from student records: 5 is state and municipal, 0 is all of them.
COMPOSITES = (CompositeGroup("5", ("2", "3")), CompositeGroup("0"))

STUDENT_METRICS = MetricColumns(
    groups=("ano", "id_municipio", "serie"),
    network="rede",
    present="presenca",
    success="alfabetizado",
    score="proficiencia",
    weight="peso_aluno",
)


def _columns(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


def result_schema(place: str) -> T.StructType:
    """Published result: rate, mean score and the share of students per level."""
    return T.StructType(
        [
            T.StructField("ano", T.IntegerType()),
            *_columns([place, "serie", "rede"], T.StringType()),
            *_columns(["taxa_alfabetizacao", "media_portugues"], T.DoubleType()),
            *_columns([f"{LEVEL_PREFIX}{n}" for n in LEVELS], T.DoubleType()),
        ]
    )


def target_schema(
    place: str | None, with_level: bool = False, years: Iterable[int] = TARGET_YEARS
) -> T.StructType:
    """Agreed targets, one column per year."""
    return T.StructType(
        [
            T.StructField("ano", T.IntegerType()),
            *_columns([place] if place else [], T.StringType()),
            T.StructField("rede", T.StringType()),
            T.StructField("taxa_alfabetizacao", T.DoubleType()),
            *_columns([f"{TARGET_PREFIX}{y}" for y in years], T.DoubleType()),
            *_columns(["nivel_alfabetizacao"] if with_level else [], T.IntegerType()),
            T.StructField("percentual_participacao", T.DoubleType()),
        ]
    )


STATES = Dimension(
    "uf",
    "sigla_uf",
    (("sigla", "sigla_uf"), ("nome", "nome_uf"), ("regiao", "nome_regiao")),
    source_file="br_bd_diretorios_brasil_uf.csv",
)
MUNICIPALITIES = Dimension(
    "municipio",
    "id_municipio",
    (
        ("id_municipio", "id_municipio"),
        ("nome", "nome_municipio"),
        ("sigla_uf", "sigla_uf"),
        ("nome_uf", "nome_uf"),
        ("nome_regiao", "nome_regiao"),
    ),
    source_file="br_bd_diretorios_brasil_municipio.csv",
)
DIMENSIONS = {d.name: d for d in (STATES, MUNICIPALITIES)}


def _published(name: str, place: str | None, dimension: str | None, **parts) -> EntityContract:
    return EntityContract(
        name=name,
        integers=("ano", *parts.pop("more_integers", ())),
        texts=(*([place] if place else []), *parts.pop("more_texts", ()), "rede"),
        double_prefixes=(LEVEL_PREFIX, TARGET_PREFIX),
        dimension=dimension,
        codes=(NETWORKS, GRADES),
        compact=True,
        source_file=f"{SOURCE_PREFIX}{name}.csv",
        **parts,
    )


def _result(name: str, place: str, dimension: str) -> EntityContract:
    measures = ("taxa_alfabetizacao", "media_portugues")
    return _published(
        name,
        place,
        dimension,
        keys=("ano", place, "serie", "rede"),
        more_texts=("serie",),
        doubles=measures,
        critical=("ano", place, *measures),
        source_schema=result_schema(place),
    )


def _target(
    name: str,
    place: str | None,
    dimension: str | None,
    years: Iterable[int],
    level: bool = False,
) -> EntityContract:
    where = (place,) if place else ()
    return _published(
        name,
        place,
        dimension,
        keys=("ano", *where, "rede"),
        more_integers=("nivel_alfabetizacao",) if level else (),
        doubles=("taxa_alfabetizacao", "percentual_participacao"),
        critical=("ano", *where, "taxa_alfabetizacao"),
        source_schema=target_schema(place, level, years),
    )


def published(years: Iterable[int] = TARGET_YEARS) -> tuple[EntityContract, ...]:
    """Contracts of the five published tables, with a target column for each of ``years``."""
    return (
        _result(STATE_RESULT, "sigla_uf", "uf"),
        _result(MUNICIPAL_RESULT, "id_municipio", "municipio"),
        _target(NATIONAL_TARGET, None, None, years),
        _target(STATE_TARGET, "sigla_uf", "uf", years),
        _target(MUNICIPAL_TARGET, "id_municipio", "municipio", years, level=True),
    )


STUDENTS = EntityContract(
    name=STUDENT,
    keys=("ano", "id_aluno", "id_escola"),
    integers=("ano", "alfabetizado", "presenca"),
    doubles=("preenchimento_caderno", "proficiencia", "peso_aluno"),
    texts=("id_municipio", "id_escola", "id_aluno", "caderno", "serie", "rede"),
    critical=("ano", "id_aluno", "alfabetizado"),
    dimension="municipio",
    codes=(NETWORKS, GRADES),
)

STUDENT_PAYLOAD = PayloadSpec(
    fields=(
        "ano",
        "id_municipio",
        "id_escola",
        "id_aluno",
        "caderno",
        "serie",
        "rede",
        "presenca",
        "preenchimento_caderno",
        "alfabetizado",
        "proficiencia",
        "peso_aluno",
    ),
    typed=(
        ("preenchimento_caderno", "double"),
        ("alfabetizado", "int"),
        ("proficiencia", "double"),
        ("peso_aluno", "double"),
    ),
)

CONTRACTS = (*published(), STUDENTS)
REQUIRED = (MUNICIPAL_RESULT, STATE_RESULT)

# Each measure against the target at the three territorial scales.
STATUSES = (
    StatusSpec(
        "meta_atingida_municipio", "taxa_alfabetizacao_municipio", "meta_alfabetizacao_municipio"
    ),
    StatusSpec("meta_atingida_uf", "taxa_alfabetizacao_uf", "meta_alfabetizacao_uf"),
    StatusSpec(
        "meta_atingida_brasil", "taxa_alfabetizacao_brasil_oficial", "meta_alfabetizacao_brasil"
    ),
    StatusSpec(
        "meta_atingida_presenca_municipio",
        "proporcao_presenca",
        "percentual_participacao_municipio",
    ),
    StatusSpec(
        "meta_atingida_presenca_uf", "proporcao_presenca", "percentual_participacao_uf"
    ),
    StatusSpec(
        "meta_atingida_presenca_brasil", "proporcao_presenca", "percentual_participacao_brasil"
    ),
)

# The columns of the analytical table, in order.
ANALYTICAL_COLUMNS = (
    "ano", "id_municipio", "nome_municipio", "sigla_uf", "nome_uf", "nome_regiao", "serie", "serie_nome", "rede", "rede_nome",
    "alunos_total", "alunos_presentes", "alunos_alfabetizados",
    "proporcao_presenca", "taxa_alfabetizacao_observada",
    "proficiencia_media", "proficiencia_media_ponderada",
    "taxa_alfabetizacao_municipio", "media_portugues_municipio",
    "meta_alfabetizacao_municipio", "percentual_participacao_municipio",
    "meta_atingida_municipio", "meta_atingida_presenca_municipio",
    "taxa_alfabetizacao_uf", "media_portugues_uf",
    "meta_alfabetizacao_uf", "percentual_participacao_uf",
    "meta_atingida_uf", "meta_atingida_presenca_uf",
    "taxa_alfabetizacao_brasil", "media_portugues_brasil", "taxa_alfabetizacao_brasil_oficial",
    "meta_alfabetizacao_brasil", "percentual_participacao_brasil",
    "meta_atingida_brasil", "meta_atingida_presenca_brasil",
)

#: Further columns of the analytical table: what the weighted mean of a slice is made of.
SLICE_SUMS = ("soma_proficiencia_peso", "soma_peso")
