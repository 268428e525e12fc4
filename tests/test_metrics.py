import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terrace.contracts import CompositeGroup
from terrace.functions.numbers import (
    bin_start,
    exact_mean,
    half_up_quotient,
    percent,
    whole_number,
)
from terrace.operators.compare import change_from_previous_year, share_of_group
from terrace.operators.metrics import mean_of_groups, student_metrics
from terrace.plans import literacy as L

STUDENT = (
    "ano int, id_municipio string, serie string, rede string, presenca int, alfabetizado int, "
    "proficiencia double, peso_aluno double"
)


def half_up(value):
    if value is None:
        return None
    cents = Decimal(value.numerator) / Decimal(value.denominator)
    return float(cents.quantize(Decimal("0.01"), ROUND_HALF_UP))


def brute_force(people):
    members = {"5": {"2", "3"}}
    groups = defaultdict(list)
    for p in people:
        for code in [p[3], "0"] + (["5"] if p[3] in members["5"] else []):
            groups[(*p[:3], code)].append(p)
    out = []
    for key, group in groups.items():
        here = [p for p in group if p[4] == 1]
        scored = [p for p in group if p[6] is not None]
        exact = [(Fraction(str(p[6])), Fraction(str(p[7]))) for p in scored]
        weight = sum(w for _, w in exact)
        out.append(
            (
                *key,
                len(group),
                len(here),
                sum(p[5] for p in here),
                half_up(Fraction(100 * len(here), len(group))),
                half_up(Fraction(100 * sum(p[5] for p in here), len(here))) if here else None,
                half_up(sum(x for x, _ in exact) / len(exact)) if exact else None,
                half_up(sum(x * w for x, w in exact) / weight) if weight else None,
            )
        )
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force_with_a_hot_group(spark, rows, seed):
    rng = random.Random(seed)
    people = []
    for _ in range(1500):
        hot = rng.random() < 1 / 3
        present = int(rng.random() < 0.8)
        people.append(
            (
                2024 if hot else rng.choice([2023, 2024]),
                "m0" if hot else f"m{rng.randrange(40)}",
                "2",
                "3" if hot else rng.choice(["2", "3", "4"]),
                present,
                int(present and rng.random() < 0.5),
                rng.randrange(50000, 90000) / 100 if present else None,
                rng.randrange(1, 300) / 100 if present else None,
            )
        )
    df = spark.createDataFrame(people, STUDENT).repartition(7)
    found = student_metrics(df, L.STUDENT_METRICS, L.COMPOSITES).select(
        "ano", "id_municipio", "serie", "rede", "alunos_total", "alunos_presentes",
        "alunos_alfabetizados", "proporcao_presenca", "taxa_alfabetizacao_observada",
        "proficiencia_media", "proficiencia_media_ponderada",
    )
    key = lambda t: tuple(str(v) for v in t[:4])
    assert sorted(rows(found), key=key) == sorted(brute_force(people), key=key)


def test_one_scan_and_hash_aggregates(spark, capsys, tmp_path):
    path = str(tmp_path / "people")
    spark.createDataFrame([(2024, "m", "2", "3", 1, 1, 1.0, 1.0)], STUDENT).write.parquet(path)
    student_metrics(spark.read.parquet(path), L.STUDENT_METRICS, L.COMPOSITES).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan and "Window" not in plan


def test_success_of_the_absent_does_not_count(spark, rows):
    df = spark.createDataFrame([(2024, "m", "2", "4", 0, 1, None, None)], STUDENT)
    found = student_metrics(df, L.STUDENT_METRICS)
    assert rows(found) == [(2024, "m", "2", "4", 1, 0, 0, 0.0, None, None, None)]


def test_weight_without_score_and_nan_are_left_out(spark, rows):
    df = spark.createDataFrame(
        [
            (2024, "m", "2", "4", 1, 1, 700.0, 1.0),
            (2024, "m", "2", "4", 1, 0, None, 9.0),
            (2024, "m", "2", "4", 1, 0, float("nan"), 9.0),
        ],
        STUDENT,
    )
    found = student_metrics(df, L.STUDENT_METRICS)
    assert rows(found, "proficiencia_media", "proficiencia_media_ponderada") == [(700.0, 700.0)]


def test_base_code_that_is_a_composite_code_fails(spark):
    df = spark.createDataFrame([(2024, "m", "2", "5", 1, 1, 1.0, 1.0)], STUDENT)
    with pytest.raises(Exception, match="network code is a composite code: 5"):
        student_metrics(df, L.STUDENT_METRICS, L.COMPOSITES).collect()


def test_network_that_is_null_counts_in_the_total(spark, rows):
    df = spark.createDataFrame([(2024, "m", "2", None, 1, 1, 1.0, 1.0)], STUDENT)
    found = student_metrics(df, L.STUDENT_METRICS, (CompositeGroup("0"),))
    assert rows(found, "rede", "alunos_total") == [("0", 1), (None, 1)]


def test_rounding_is_half_up_and_symmetric(spark, rows):
    df = spark.createDataFrame([(1, 8), (-1, 8), (1, 3), (2, 3), (5, 0), (0, 5)], "a int, b int")
    found = df.select("a", "b", half_up_quotient(F.col("a"), F.col("b")).alias("q"))
    assert rows(found) == [
        (-1, 8, -0.13), (0, 5, 0.0), (1, 3, 0.33), (1, 8, 0.13), (2, 3, 0.67), (5, 0, None),
    ]
    assert rows(df.limit(1).select(percent(F.lit(1), F.lit(800)))) == [(0.13,)]


def test_mean_does_not_depend_on_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7 / 100 + 0.005).alias("x"))
    means = {
        df.repartition(n).agg(exact_mean(F.col("x"), 4).alias("m")).first()["m"] for n in (1, 3, 8)
    }
    assert len(means) == 1


def test_mean_of_groups_ignores_group_size(spark, rows):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.005), ("b", None)], "g string, x double")
    assert rows(mean_of_groups(df, ["g"], {"x": "m"})) == [("a", 15.0), ("b", None)]


def test_bins(spark, rows):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (99.9,), (-0.1,)], "x double")
    assert rows(df.select(bin_start(F.col("x"), 5))) == [(-5,), (0,), (0,), (5,), (95,)]


def test_whole_number(spark, rows):
    df = spark.createDataFrame([("12",), ("3.7",), ("",), ("x",), (None,)], "t string")
    assert rows(df.select(whole_number(F.col("t")))) == [(12,), (3,), (None,), (None,), (None,)]


def test_change_skips_a_missing_year(spark, rows, capsys):
    data = [
        ("a", 2020, 50.0, "x"), ("a", 2021, 55.0, "y"), ("a", 2023, 60.0, "z"), ("b", 2021, 1.0, None)
    ]
    df = spark.createDataFrame(data, "k string, ano int, taxa double, note string")
    changed = change_from_previous_year(df, ["k"], "ano", "taxa", "delta")
    assert changed.columns == ["k", "ano", "taxa", "note", "delta"]
    assert rows(changed) == [
        ("a", 2020, 50.0, "x", None), ("a", 2021, 55.0, "y", 5.0),
        ("a", 2023, 60.0, "z", None), ("b", 2021, 1.0, None, None),
    ]
    null_value = df.withColumn("taxa", F.when(F.col("ano") != 2020, F.col("taxa")))
    again = change_from_previous_year(null_value, ["k"], "ano", "taxa", "delta")
    of_a = rows(again.filter("k = 'a'"), "ano", "delta")
    assert of_a == [(2020, None), (2021, None), (2023, None)]


def test_shares_of_a_group_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 7)], "g string, n int")
    shares = share_of_group(df, ["g"], "n", "pct").groupBy("g").agg(F.sum("pct").alias("s"))
    assert {round(r["s"], 9) for r in shares.collect()} == {100.0}


def test_small_weights_and_large_values_lose_nothing(spark, rows):
    means = spark.createDataFrame([(1e13,), (1.0,)], "x double").agg(exact_mean(F.col("x")))
    assert rows(means) == [(5_000_000_000_000.5,)]
    for weights, mean in (((2.5e-7, 2.5e-7), 743.25), ((1e-6, 2.5e-6), 712.36)):
        scores = (743.25, 743.25) if mean == 743.25 else (770.0, 689.304)
        people = [
            (2024, "m", "2", "2", 1, 1, s, w) for s, w in zip(scores, weights, strict=True)
        ]
        df = spark.createDataFrame(people, STUDENT)
        found = student_metrics(df, L.STUDENT_METRICS)
        assert rows(found, "proficiencia_media_ponderada") == [(mean,)]
    huge = [(2024, "m", "2", "2", 1, 1, 9e15, 9e15)] * 2
    found = student_metrics(spark.createDataFrame(huge, STUDENT), L.STUDENT_METRICS)
    assert rows(found, "proficiencia_media_ponderada") == [(9e15,)]
