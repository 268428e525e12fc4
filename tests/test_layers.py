"""The literacy run on small source files, with figures worked out by hand."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from terrace.contracts import Slice
from terrace.functions.lineage import Run
from terrace.plans import literacy as L
from terrace.plans import reports
from terrace.plans.layers import (
    build_analytical,
    check_layers,
    conform,
    register_layers,
    run_layers,
)
from terrace.sources.layers import MissingInput, Store
from terrace.streaming.ingest import batch_writer, drain, file_records, read_rejected
from terrace.streaming.records import RECORD_SCHEMA

RUN = Run(datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc))

LEVELS = ",".join(f"proporcao_aluno_nivel_{n}" for n in range(9))
TARGETS = ",".join(f"meta_alfabetizacao_{y}" for y in range(2024, 2031))
NO_LEVELS = "," * 9

FILES = {
    "br_inep_avaliacao_alfabetizacao_uf.csv": [
        f"ano,sigla_uf,serie,rede,taxa_alfabetizacao,media_portugues,{LEVELS}",
        f"2023,SP,2,3,50.0,740.1234{NO_LEVELS}",
        f"2024,SP,2,3,55.5,745.5{NO_LEVELS}",
        f"2024,SP,2,5,57.25,746{NO_LEVELS}",
        f"2024,CE,2,3,80.0,760.1{NO_LEVELS}",
    ],
    "br_inep_avaliacao_alfabetizacao_municipio.csv": [
        f"ano,id_municipio,serie,rede,taxa_alfabetizacao,media_portugues,{LEVELS}",
        f"2023,3550308,2,3,49.5,739{NO_LEVELS}",
        f"2024,3550308,2,3,60.0,750{NO_LEVELS}",
        f"2024,3550308,2,3,58.0,748{NO_LEVELS}",
        f"2024,3550308,2,5,61.0,751{NO_LEVELS}",
        f"2024,3550308,2,0,61.5,751.5{NO_LEVELS}",
        f"2024,2304400, 2 ,3,70.0,755{NO_LEVELS}",
        f"2024,9999999,2,3,not a number,700{NO_LEVELS}",
    ],
    "br_inep_avaliacao_alfabetizacao_meta_alfabetizacao_brasil.csv": [
        f"ano,rede,taxa_alfabetizacao,{TARGETS},percentual_participacao",
        "2024,Pública,59.2,59.9,63.77,67.47,70.97,74.23,77.24,80,87.37",
        "2023,Pública,55.9,59.9,63.77,67.47,70.97,74.23,77.24,80,86",
    ],
    "br_inep_avaliacao_alfabetizacao_meta_alfabetizacao_uf.csv": [
        f"ano,sigla_uf,rede,taxa_alfabetizacao,{TARGETS},percentual_participacao",
        "2024,SP,Pública,,58,60,62,64,66,68,70,80",
        "2024,CE,Pública,85.31,80,80,80,80,80,80,80,98.13",
    ],
    "br_inep_avaliacao_alfabetizacao_meta_alfabetizacao_municipio.csv": [
        f"ano,id_municipio,rede,taxa_alfabetizacao,{TARGETS},nivel_alfabetizacao,"
        "percentual_participacao",
        "2024,3550308,Municipal,60,58,60,62,64,66,68,70,3,60",
        "2024,2304400,Municipal,70,75,76,77,78,79,80,81,4,",
    ],
    "br_bd_diretorios_brasil_uf.csv": [
        "id_uf,sigla,nome,regiao",
        "35,SP,São Paulo,Sudeste",
        "35, SP ,São Paulo,Sudeste",
        "23,CE,Ceará,Nordeste",
    ],
    "br_bd_diretorios_brasil_municipio.csv": [
        "id_municipio,id_municipio_6,nome,sigla_uf,nome_uf,nome_regiao",
        "3550308,355030,São Paulo,SP,São Paulo,Sudeste",
        "2304400,230440,Fortaleza,CE,Ceará,Nordeste",
    ],
}

STUDENTS = [
    ("3550308", "E1", "001", "1", "3", "1", "1", "1", "760.5", "1.2"),
    ("3550308", "E1", "002", "", "2", "0", "", "0", "", ""),
    ("3550308", "E2", "003", "2", "4", "1", "1", "0", "700", "0.8"),
]
FIELDS = (
    "id_municipio id_escola id_aluno caderno rede presenca preenchimento_caderno alfabetizado "
    "proficiencia peso_aluno"
).split()


def payload_row(values):
    return {"ano": "2024", "serie": "2", **dict(zip(FIELDS, values))}


def payload(values):
    return json.dumps(payload_row(values), ensure_ascii=False)


def write_sources(root, files=FILES):
    (root / "arquivos").mkdir(parents=True)
    for name, lines in files.items():
        (root / "arquivos" / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def ingest_students(spark, root, label, checkpoint):
    texts = [payload(v) for v in STUDENTS] + ["{bad json", "[1, 2]"]
    records = [("k", bytearray(t, "utf-8")) for t in texts]
    published = f"{root}/published"
    if not (root / "published").exists():
        spark.createDataFrame(records, RECORD_SCHEMA).repartition(2).write.parquet(published)
    out = Store(spark, str(root)).path("bronze", L.STUDENT)
    handler = batch_writer(L.STUDENT_PAYLOAD, "student-stream", out, label, lambda: RUN)
    drain(file_records(spark, published, 1), handler, f"{root}/{checkpoint}")
    return out


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    write_sources(root)
    out = ingest_students(spark, root, "first", "checkpoint")
    reports_ = run_layers(spark, str(root), RUN)
    return root, Store(spark, str(root)), reports_, out


def by_entity(reports_, layer):
    return {r["entity"]: r for r in reports_ if r["layer"] == layer}


def test_raw_rows_and_quarantine(built, rows):
    _, store, reports_, out = built
    raw = by_entity(reports_, "bronze")
    assert raw[L.MUNICIPAL_RESULT]["rows"] == 6
    assert raw[L.MUNICIPAL_RESULT]["rejected"] == 1
    assert raw[L.STATE_RESULT]["rejected"] == 0
    kept = store.spark.read.parquet(f"{store.root}/quarantine/{L.MUNICIPAL_RESULT}")
    assert "not a number" in kept.first()["_corrupt_record"]
    lineage = store.read("bronze", L.STATE_RESULT).first()
    assert lineage["_ingestion_date"] == "2026-01-02"
    assert lineage["_ingestion_timestamp"] == "20260102_030405"
    assert lineage["_source_entity"] == "br_inep_avaliacao_alfabetizacao_uf.csv"
    assert lineage["_source_path"].endswith("/arquivos/br_inep_avaliacao_alfabetizacao_uf.csv")
    rejected = read_rejected(store.spark, out)
    assert rows(rejected, "raw_record") == [("[1, 2]",), ("{bad json",)]


def test_conformed_figures(built):
    _, store, reports_, _ = built
    conformed = by_entity(reports_, "silver")
    municipal = conformed[L.MUNICIPAL_RESULT]
    assert (municipal["rows_before"], municipal["rows"], municipal["removed"]) == (6, 5, 1)
    assert (municipal["first_year"], municipal["last_year"]) == (2023, 2024)
    assert conformed[L.STATE_TARGET]["nulls_taxa_alfabetizacao"] == 1
    table = store.read("silver", L.MUNICIPAL_RESULT)
    row = table.filter("id_municipio = '2304400'").first()
    assert (row["serie"], row["serie_nome"]) == ("2", "2º ano do Ensino Fundamental")
    assert (row["rede_nome"], row["nome_regiao"]) == ("Municipal", "Nordeste")
    assert row["_pipeline_stage"] == "silver" and row["_source_layer"] == "bronze"
    assert "_copies_of_key" not in table.columns
    student = store.read("silver", L.STUDENT)
    types = dict(student.dtypes)
    assert types["presenca"] == "int" and types["preenchimento_caderno"] == "double"
    absent = student.filter("id_aluno = '002'").first()
    assert absent["proficiencia"] is None and absent["caderno"] is None
    target = store.read("silver", L.NATIONAL_TARGET).first()
    assert target["rede_nome"] == "Pública"


def test_small_tables_get_one_file_per_year(built):
    root, _, _, _ = built
    for year in (2023, 2024):
        files = list((root / "silver" / L.MUNICIPAL_RESULT / f"ano={year}").glob("*.parquet"))
        assert len(files) == 1


def test_analytical_rows(built, rows):
    _, store, reports_, _ = built
    table = store.read("gold", L.ANALYTICAL)
    assert by_entity(reports_, "gold")[L.ANALYTICAL]["rows"] == 5
    assert set(L.ANALYTICAL_COLUMNS) <= set(table.columns)
    student_part = (
        "rede",
        "alunos_total",
        "alunos_presentes",
        "alunos_alfabetizados",
        "proporcao_presenca",
        "taxa_alfabetizacao_observada",
        "proficiencia_media",
        "proficiencia_media_ponderada",
    )
    sp = table.filter("id_municipio = '3550308' and ano = 2024")
    assert rows(sp, *student_part) == [
        ("0", 3, 2, 1, 66.67, 50.0, 730.25, 736.3),
        ("3", 1, 1, 1, 100.0, 100.0, 760.5, 760.5),
        ("5", 2, 1, 1, 50.0, 100.0, 760.5, 760.5),
    ]
    status = ("ano", "id_municipio", "rede", "meta_atingida_municipio", "meta_atingida_uf",
              "meta_atingida_brasil", "meta_atingida_presenca_municipio")
    assert rows(table, *status) == [
        (2023, "3550308", "3", "Sem meta", "Sem meta", "Sem meta", "Sem meta"),
        (2024, "2304400", "3", "Abaixo", "Atingida", "Abaixo", "Sem meta"),
        (2024, "3550308", "0", "Atingida", "Sem dado", "Abaixo", "Atingida"),
        (2024, "3550308", "3", "Atingida", "Abaixo", "Abaixo", "Atingida"),
        (2024, "3550308", "5", "Atingida", "Abaixo", "Abaixo", "Abaixo"),
    ]
    mean = table.filter("ano = 2024 and rede = '3'").first()
    assert mean["taxa_alfabetizacao_brasil"] == 67.75
    assert mean["media_portugues_brasil"] == 752.8
    assert mean["taxa_alfabetizacao_brasil_oficial"] == 59.2


def test_second_run_changes_nothing(built, rows, spark):
    root, store, _, _ = built
    columns = L.ANALYTICAL_COLUMNS
    before = rows(store.read("gold", L.ANALYTICAL), *columns)
    ingest_students(spark, root, "first", "checkpoint")
    ingest_students(spark, root, "second", "other-checkpoint")
    run_layers(spark, str(root), RUN)
    assert store.read("bronze", L.STUDENT).filter("record_status = 'valid'").count() == 6
    assert store.read("silver", L.STUDENT).count() == 3
    assert rows(store.read("gold", L.ANALYTICAL), *columns) == before


def test_checks_and_catalog(built, rows, spark):
    _, store, _, _ = built
    failed = check_layers(store).filter("not passed")
    assert rows(failed, "entity", "check", "found") == [
        (L.STATE_TARGET, "nulls in taxa_alfabetizacao", 1),
    ]
    names = register_layers(store, "lit")
    assert "`lit_gold`.`gold_alfabetizacao_analise_output`" in names
    table = spark.table("lit_gold.gold_alfabetizacao_analise_output")
    assert table.filter("ano = 2023").count() == 1


def test_reports(built, rows):
    _, store, _, _ = built
    table = store.read("gold", L.ANALYTICAL)
    wanted = Slice(year=2024, network="3")
    kpis = reports.slice_kpis(table, wanted).first().asDict()
    assert kpis == {
        "municipios": 2, "taxa_media": 65.0, "atingiram": 1, "abaixo": 1, "sem_meta": 0,
        "sem_dado": 0, "com_meta": 2, "pct_atingiu": 50.0,
    }
    assert [r["sigla_uf"] for r in reports.state_ranking(table, wanted).collect()] == ["CE", "SP"]
    change = reports.country_change(table).collect()
    assert [(r["ano"], r["delta"]) for r in change] == [(2023, None), (2024, 59.2 - 55.9)]
    diagnosis = rows(reports.below_target_diagnosis(table, wanted))
    assert diagnosis == [
        (reports.LEARNING, 0), (reports.PARTICIPATION, 0), (reports.NO_REFERENCE, 1),
    ]
    found = reports.detail(table, wanted, search="FORTA").collect()
    assert [r["id_municipio"] for r in found] == ["2304400"]
    assert reports.detail(table, wanted, search="%").count() == 0
    assert rows(reports.territories(table, "Nordeste"), "sigla_uf") == [("CE",)]
    assert set(reports.student_section(table, wanted)) == {
        "student_kpis", "attendance_and_rate", "status_crosstab", "below_target_diagnosis",
    }
    without = table.drop("proporcao_presenca")
    assert reports.student_section(without, wanted) == {}


def test_absent_optional_tables_leave_their_columns_out(built, spark, tmp_path):
    _, store, _, _ = built
    other = Store(spark, str(tmp_path))
    for name in L.REQUIRED:
        store.read("silver", name).write.parquet(other.path("silver", name))
    build_analytical(other, RUN)
    table = other.read("gold", L.ANALYTICAL)
    assert table.count() == 5
    for gone in ("alunos_total", "meta_alfabetizacao_uf", "meta_atingida_brasil"):
        assert gone not in table.columns


def test_source_without_rows_counts_as_absent(spark, tmp_path):
    files = {name: lines[:1] if "meta_alf" in name else lines for name, lines in FILES.items()}
    write_sources(tmp_path, files)
    reports_ = run_layers(spark, str(tmp_path), RUN)
    assert by_entity(reports_, "bronze")[L.STATE_TARGET]["rows"] == 0
    assert L.STATE_TARGET not in by_entity(reports_, "silver")
    table = Store(spark, str(tmp_path)).read("gold", L.ANALYTICAL)
    assert table.count() == 5 and "meta_atingida_uf" not in table.columns


def test_a_year_that_is_gone_stays_unless_all_is_replaced(spark, rows, tmp_path):
    write_sources(tmp_path)
    only = [c for c in L.CONTRACTS if c.name == L.STATE_RESULT]
    chosen = {"contracts": only, "layers": ("bronze",)}
    run_layers(spark, str(tmp_path), RUN, **chosen)
    source = tmp_path / "arquivos" / only[0].source_file
    kept = [line for line in FILES[only[0].source_file] if not line.startswith("2023")]
    source.write_text("\n".join(kept) + "\n", encoding="utf-8")
    for replace_all, years in ((False, [(2023,), (2024,)]), (True, [(2024,)])):
        run_layers(spark, str(tmp_path), RUN, replace_all=replace_all, **chosen)
        table = Store(spark, str(tmp_path)).read("bronze", L.STATE_RESULT)
        assert rows(table.select("ano").distinct()) == years


def test_missing_required_table_is_an_error(spark, tmp_path):
    with pytest.raises(MissingInput, match=L.STATE_RESULT):
        build_analytical(Store(spark, str(tmp_path)), RUN)


def test_renamed_header_fails(spark, tmp_path):
    files = dict(FILES)
    name = "br_inep_avaliacao_alfabetizacao_uf.csv"
    files[name] = [files[name][0].replace("serie", "grade"), *files[name][1:]]
    write_sources(tmp_path, files)
    with pytest.raises(Exception, match="CSV header"):
        run_layers(spark, str(tmp_path), RUN)


def test_one_shuffle_from_raw_to_conformed(spark, capsys):
    """Deduplication is the only exchange of the fact, and it sorts for the write as well."""
    students = spark.createDataFrame([payload_row(v) for v in STUDENTS])
    places = spark.createDataFrame([("3550308", "SP")], "id_municipio string, sigla_uf string")
    tables = {"municipio": F.broadcast(places)}
    table = conform(students, L.STUDENTS, L.DIMENSIONS, tables, RUN, "copies")
    table.sortWithinPartitions("ano").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert plan.count("Sort [") == 2


def test_rows_without_a_key_go_to_the_quarantine(spark, tmp_path):
    files = dict(FILES)
    name = "br_inep_avaliacao_alfabetizacao_uf.csv"
    files[name] = [*files[name], f"2024,,2,3,1.0,700{NO_LEVELS}", f"2024,,2,3,2.0,700{NO_LEVELS}"]
    write_sources(tmp_path, files)
    found = run_layers(spark, str(tmp_path), RUN, layers=("bronze", "silver"))
    state = next(r for r in found if r["layer"] == "silver" and r["entity"] == L.STATE_RESULT)
    assert (state["without_key"], state["rows"], state["removed"]) == (2, 4, 0)
    aside = spark.read.parquet(f"{tmp_path}/quarantine/{L.STATE_RESULT}_without_key")
    assert aside.count() == 2 and aside.filter("sigla_uf is not null").isEmpty()


def test_repeated_target_key_fails(built, spark):
    from terrace.plans.analytical import analytical_table

    _, store, _, _ = built
    tables = store.read_present("silver", [c.name for c in L.CONTRACTS])
    target = tables[L.STATE_TARGET]
    tables[L.STATE_TARGET] = target.unionByName(target.withColumn("rede", F.lit("Municipal")))
    with pytest.raises(Exception, match="has several rows for ano, sigla_uf = 2024"):
        analytical_table(tables).collect()
