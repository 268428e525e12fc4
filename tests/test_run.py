"""The jobs, as they are submitted."""

import pytest

import run
from terrace.plans import literacy as L
from terrace.sources.layers import Store
from tests.test_layers import FILES, STUDENTS, payload, write_sources
from terrace.streaming.records import RECORD_SCHEMA


def test_jobs_in_order(spark, tmp_path, capsys):
    root = str(tmp_path)
    write_sources(tmp_path)
    records = [("k", bytearray(payload(v), "utf-8")) for v in STUDENTS]
    spark.createDataFrame(records, RECORD_SCHEMA).write.parquet(f"{root}/published")
    job = ["stream", "--root", root, "--label", "first", "--records", f"{root}/published"]
    for _ in range(2):
        assert run.main([*job, "--drain"]) == 0
    assert run.main(["layers", "--root", root, "--only", "bronze"]) == 0
    assert Store(spark, root).read_if_present("silver", L.STATE_RESULT) is None
    assert run.main(["layers", "--root", root, "--only", "silver", "gold"]) == 0
    table = Store(spark, root).read("gold", L.ANALYTICAL)
    assert table.filter("rede = '0'").first()["alunos_total"] == 3
    assert run.main(["checks", "--root", root]) == 0
    capsys.readouterr()
    assert run.main(["register", "--root", root, "--database", "jobs"]) == 0
    assert "`jobs_gold`.`gold_alfabetizacao_analise_output`" in capsys.readouterr().out


def test_upkeep_jobs(spark, tmp_path, capsys):
    root = str(tmp_path)
    write_sources(tmp_path)
    for part in (0, 1, 2):
        records = [("k", bytearray(payload(v), "utf-8")) for v in STUDENTS]  # the same again
        spark.createDataFrame(records, RECORD_SCHEMA).write.mode("append").parquet(f"{root}/published")
        job = ["stream", "--root", root, "--label", "first", "--records", f"{root}/published"]
        assert run.main([*job, "--unique", "7 days", "--drain"]) == 0
    students = Store(spark, root).read("bronze", L.STUDENT)
    assert students.groupBy("ano", "id_aluno", "id_escola").count().filter("count > 1").isEmpty()
    capsys.readouterr()
    assert run.main(["refresh", "--root", root]) == 0
    assert "gold" in capsys.readouterr().out
    assert run.main(["refresh", "--root", root]) == 0
    assert capsys.readouterr().out == ""
    assert run.main(["compact", "--root", root, "--sweep"]) == 0
    with pytest.raises(SystemExit):
        run.main(["stream", "--root", root, "--label", "a", "--kafka", "h", "--unique", "1 day"])


def test_an_orphan_fails_the_job(spark, tmp_path):
    files = dict(FILES)
    name = "br_bd_diretorios_brasil_municipio.csv"
    files[name] = files[name][:-1]
    write_sources(tmp_path, files)
    run.main(["layers", "--root", str(tmp_path), "--only", "bronze", "silver"])
    assert run.main(["checks", "--root", str(tmp_path)]) == 1


def test_root_is_required():
    with pytest.raises(SystemExit):
        run.main(["layers"])
