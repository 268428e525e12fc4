"""Published figures of the real state files; runs where ``ASSESSMENT_CSV_DIR`` names them."""

import os

import pytest
from pyspark.sql import functions as F

from terrace.functions.lineage import Run
from terrace.functions.numbers import bin_start
from terrace.operators.metrics import mean_of_groups
from terrace.plans import literacy as L
from terrace.plans.analytical import add_statuses, targets_for
from terrace.plans.layers import conform
from terrace.sources.csv import read_csv, valid_rows
from terrace.functions.lineage import raw_lineage

FOLDER = os.environ.get("ASSESSMENT_CSV_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="ASSESSMENT_CSV_DIR not set")


def table(spark, name):
    contract = next(c for c in L.CONTRACTS if c.name == name)
    raw = valid_rows(read_csv(spark, f"{FOLDER}/{contract.source_file}", contract.source_schema))
    raw = raw_lineage(raw, Run(), contract.source_file, FOLDER)
    return conform(raw, contract, {}, {}, Run(), "copies")


def test_state_results(spark, rows):
    state = table(spark, L.STATE_RESULT)
    assert state.count() == 145
    assert state.agg(F.max("copies")).first()[0] == 1
    assert state.select("sigla_uf").distinct().count() == 25
    counts = state.groupBy("ano", "rede").count()
    assert rows(counts) == [
        (2023, "2", 22), (2023, "3", 24), (2023, "5", 24),
        (2024, "0", 1), (2024, "2", 24), (2024, "3", 25), (2024, "5", 25),
    ]
    assert state.filter("proporcao_aluno_nivel_0 is null").count() == 70


def test_national_means(spark, rows):
    measures = {"taxa_alfabetizacao": "t", "media_portugues": "m"}
    state = table(spark, L.STATE_RESULT)
    means = mean_of_groups(state, ["ano", "rede"], measures, 4)
    assert rows(means, "ano", "rede", "t") == [
        (2023, "2", 57.8868), (2023, "3", 54.0329), (2023, "5", 54.2513),
        (2024, "0", 35.96), (2024, "2", 60.1342), (2024, "3", 56.2968), (2024, "5", 56.6120),
    ]
    rounded = mean_of_groups(state, ["ano", "rede"], measures).filter("ano = 2024")
    assert rows(rounded, "rede", "m") == [
        ("0", 725.58), ("2", 748.61), ("3", 745.45), ("5", 745.73),
    ]


def test_state_status(spark, rows):
    targets = targets_for(table(spark, L.STATE_TARGET), "uf", ("sigla_uf",))
    assert targets.count() == 54
    state = table(spark, L.STATE_RESULT).join(targets, ["ano", "sigla_uf"], "left")
    spec = [s for s in L.STATUSES if s.flag == "meta_atingida_uf"]
    judged = add_statuses(
        state.withColumnRenamed("taxa_alfabetizacao", "taxa_alfabetizacao_uf"), spec
    )
    counts = judged.filter("ano = 2024 and rede in ('2', '3', '5')").groupBy(
        "rede", "meta_atingida_uf"
    ).count()
    assert rows(counts) == [
        ("2", "Abaixo", 11), ("2", "Atingida", 12), ("2", "Sem meta", 1),
        ("3", "Abaixo", 14), ("3", "Atingida", 10), ("3", "Sem meta", 1),
        ("5", "Abaixo", 13), ("5", "Atingida", 11), ("5", "Sem meta", 1),
    ]
    assert rows(judged.filter("ano = 2023").groupBy("meta_atingida_uf").count()) == [
        ("Sem meta", 70),
    ]
    none = targets.filter("ano = 2024 and meta_alfabetizacao_uf is null")
    assert rows(none, "sigla_uf") == [("AC",), ("DF",), ("RR",)]


def test_histogram(spark, rows):
    public = table(spark, L.STATE_RESULT).filter("ano = 2024 and rede = '5'")
    bins = public.groupBy(bin_start(F.col("taxa_alfabetizacao"), 5).alias("b")).count()
    assert rows(bins) == [
        (35, 3), (40, 1), (45, 4), (50, 2), (55, 6), (60, 4), (70, 4), (85, 1),
    ]
