import pytest
from pyspark.sql import functions as F

from terrace.contracts import Slice
from terrace.plans import reports

SCHEMA = """
ano int, id_municipio string, nome_municipio string, sigla_uf string, nome_uf string,
nome_regiao string, serie string, rede string, rede_nome string,
alunos_total bigint, alunos_presentes bigint, alunos_alfabetizados bigint,
proporcao_presenca double, taxa_alfabetizacao_observada double,
proficiencia_media_ponderada double,
soma_proficiencia_peso double, soma_peso double,
taxa_alfabetizacao_municipio double, meta_alfabetizacao_municipio double,
meta_atingida_municipio string, meta_atingida_presenca_municipio string,
taxa_alfabetizacao_uf double, meta_alfabetizacao_uf double, meta_atingida_uf string,
taxa_alfabetizacao_brasil_oficial double, meta_alfabetizacao_brasil double,
percentual_participacao_brasil double
"""

MET, BELOW, NO_TARGET, NO_DATA = "Atingida", "Abaixo", "Sem meta", "Sem dado"


def row(
    place, state, region, rate, target, status, attendance, year=2024, network="3", grade="2"
):
    weight = float(place)
    mean = (750.5, (740 + weight) * weight, weight)
    students = (10, 8, 4, 80.0, 50.0, *mean) if rate is not None else (None,) * 8
    return (
        year, place, f"Cidade {place}", state, f"Estado {state}", region, grade, network,
        "Municipal", *students, rate, target, status, attendance,
        {"SP": 60.0, "RJ": 60.0, "CE": 85.0}[state], 61.0, BELOW, 59.2, 60.0, 87.0,
    )


@pytest.fixture(scope="module")
def table(spark):
    data = [
        row("1", "SP", "Sudeste", 70.0, 60.0, MET, MET),
        row("2", "SP", "Sudeste", 55.0, 60.0, BELOW, MET),
        row("3", "RJ", "Sudeste", 70.0, None, NO_TARGET, BELOW),
        row("4", "CE", "Nordeste", 54.99, 60.0, BELOW, BELOW),
        row("5", "CE", "Nordeste", None, 60.0, NO_DATA, None),
        row("6", "CE", "Nordeste", 30.0, 60.0, BELOW, NO_TARGET),
        row("6", "CE", "Nordeste", 31.0, 60.0, BELOW, NO_TARGET, network="0"),
        row("6", "CE", "Nordeste", 32.0, None, NO_TARGET, NO_TARGET, year=2023),
        row("6", "CE", "Nordeste", 33.0, 60.0, BELOW, None, grade="5", network="4"),
    ]
    return spark.createDataFrame(data, SCHEMA).withColumns(
        {
            "media_portugues_municipio": F.lit(740.5),
            "percentual_participacao_municipio": F.lit(87.0),
        }
    )


WANTED = Slice(year=2024, network="3")


def test_kpis(table, rows):
    columns = (
        "municipios", "taxa_media", "atingiram", "abaixo", "sem_meta", "sem_dado", "com_meta",
        "pct_atingiu",
    )
    kpis = reports.slice_kpis(table, WANTED)
    assert rows(kpis, *columns) == [(6, 56.0, 1, 3, 1, 1, 4, 25.0)]
    state = reports.slice_kpis(table, Slice(2024, "3", region="Sudeste", state="RJ"))
    assert rows(state, *columns) == [(1, 70.0, 0, 0, 1, 0, 0, None)]
    empty = reports.slice_kpis(table, Slice(2030))
    assert rows(empty, *columns) == [(0, None, 0, 0, 0, 0, 0, None)]


def test_grade_is_part_of_a_slice(table):
    assert reports.slice_kpis(table, Slice(2024, grade="5")).first()["municipios"] == 1


def test_ranking_breaks_ties_by_state(table):
    ranking = reports.state_ranking(table, WANTED).collect()
    assert [(r["sigla_uf"], r["taxa_uf"]) for r in ranking] == [
        ("CE", 85.0), ("RJ", 60.0), ("SP", 60.0),
    ]


def test_histogram_edges(table):
    bins = reports.rate_histogram(table, WANTED).collect()
    assert [tuple(r) for r in bins] == [(30, 1, 35), (50, 1, 55), (55, 1, 60), (70, 2, 75)]


def test_status_by_region_in_display_order(table):
    found = reports.status_by_region(table, WANTED).collect()
    assert [(r["nome_regiao"], r["status_meta"], r["municipios"]) for r in found] == [
        ("Nordeste", BELOW, 2), ("Nordeste", NO_DATA, 1),
        ("Sudeste", MET, 1), ("Sudeste", BELOW, 1), ("Sudeste", NO_TARGET, 1),
    ]
    assert found[0]["pct"] == pytest.approx(200 / 3)


def test_extremes(table):
    top = reports.extremes(table, WANTED, n=2).collect()
    assert [r["rotulo"] for r in top] == ["Cidade 1 (SP)", "Cidade 3 (RJ)"]
    bottom = reports.extremes(table, WANTED, highest=False, n=1).collect()
    assert [tuple(r)[:4] for r in bottom] == [("Cidade 6", "CE", 30.0, 60.0)]


def test_student_kpis(table, rows):
    """Places 1 to 4 and 6 weigh 1 to 4 and 6, and their means are 741 to 744 and 746."""
    assert rows(reports.student_kpis(table, WANTED)) == [
        (50, 40, 20, 80.0, 50.0, 750.5, 744.13, 7.5)
    ]
    nothing = reports.student_kpis(table, Slice(2030))
    assert rows(nothing) == [(None,) * 8]


def test_points(table):
    points = reports.attendance_and_rate(table, WANTED).collect()
    assert [r["nome_municipio"] for r in points] == [f"Cidade {n}" for n in "12346"]
    assert len(reports.attendance_and_rate(table, WANTED, limit=2).collect()) == 2
    assert reports.attendance_and_rate(table, WANTED, limit=None).count() == 5


def test_crosstab_and_diagnosis_agree(table, rows):
    cross = reports.status_crosstab(table, WANTED)
    assert cross.agg(F.sum("municipios")).first()[0] == 6
    below = cross.filter(F.col("status_meta") == BELOW).agg(F.sum("municipios")).first()[0]
    diagnosis = reports.below_target_diagnosis(table, WANTED)
    assert rows(diagnosis) == [
        (reports.LEARNING, 1), (reports.PARTICIPATION, 1), (reports.NO_REFERENCE, 1),
    ]
    assert below == 3
    none = reports.below_target_diagnosis(table, Slice(2023))
    assert {r["municipios"] for r in none.collect()} == {0}


def test_detail(table):
    names = [r["id_municipio"] for r in reports.detail(table, WANTED).collect()]
    assert names == ["1", "3", "2", "4", "6", "5"]
    assert len(reports.detail(table, WANTED, limit=2).collect()) == 2
    found = reports.detail(table, Slice(2024, "3", region="Nordeste"), search="cidade").collect()
    assert {r["id_municipio"] for r in found} == {"4", "5", "6"}


def test_choices(table):
    years = reports.years_and_networks(table).collect()
    assert [(r["ano"], r["rede"]) for r in years] == [
        (2024, "0"), (2024, "3"), (2024, "4"), (2023, "3"),
    ]
    states = [r["sigla_uf"] for r in reports.territories(table).collect()]
    assert states == ["CE", "RJ", "SP"]


def test_change_of_the_country(table):
    found = reports.country_change(table.withColumn(
        "taxa_alfabetizacao_brasil_oficial", F.when(F.col("ano") == 2024, 59.5).otherwise(55.0)
    )).collect()
    assert [(r["ano"], r["delta"], r["gap"]) for r in found] == [
        (2023, None, -5.0), (2024, 4.5, -0.5),
    ]


def test_top_results(spark, rows):
    data = [(2024, "SP", "2", "3", 50.0, 1.0), (2024, "CE", "2", "3", 80.0, 2.0),
            (2024, "RR", "2", "3", None, None), (2023, "SP", "2", "3", 99.0, 3.0)]
    df = spark.createDataFrame(
        data, "ano int, sigla_uf string, serie string, rede string, "
        "taxa_alfabetizacao double, media_portugues double"
    )
    assert [r["sigla_uf"] for r in reports.top_results(df, 2024).collect()] == ["CE", "SP", "RR"]
    assert rows(reports.top_results(df, 2024, n=1)) == [(2024, "CE", "3", 80.0, 2.0)]


def test_reports_read_one_year_and_few_columns(table, tmp_path, spark, capsys):
    from terrace.sources.layers import write_layer

    path = str(tmp_path / "gold")
    write_layer(table, path, compact=True)
    reports.slice_kpis(spark.read.parquet(path), WANTED).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(ano" in plan and "= 2024" in plan
    assert "PushedFilters: [IsNotNull(rede), EqualTo(rede,3)]" in plan
    columns = "id_municipio:string,rede:string,taxa_alfabetizacao_municipio:double"
    assert f"ReadSchema: struct<{columns},meta_atingida_municipio:string>" in plan
    reports.extremes(spark.read.parquet(path), WANTED).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out
