"""The analyses, sketches and samples against plain Python."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terrace.functions.targets import gap_to_target, target_status
from terrace.functions.text import contains_any_form
from terrace.operators.sketches import (
    distinct_of_slices,
    distinct_sketches,
    stratified_sample,
    within_error,
)
from terrace.plans import analyses


def _rates(n=400):
    draw, made = random.Random(5), []
    for i in range(n):
        place = i % 60
        made.append((1994 + i // 60, f"m{place}", f"s{place % 9}", f"r{place % 9 % 3}", round(draw.uniform(20, 95), 2)))
    made += [(1995, "m1", "s1", "r1", None), (1995, "lone", "s20", "r9", 50.0), (1995, "m2", "s2", "r2", float("nan"))]
    return made


SCHEMA = "ano int, place string, state string, region string, rate double"


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame(_rates(), SCHEMA).repartition(3).cache()


def _valid():
    return [r for r in _rates() if r[4] is not None and r[4] == r[4]]


def test_inequality_adds_up(rates):
    found = analyses.inequality(rates, "rate", ["state", "region"], ["ano"]).collect()
    years = {r[0] for r in _valid()}
    assert {r["ano"] for r in found} == years
    for row in found:
        own = [r for r in _valid() if r[0] == row["ano"]]
        parts = [row["within_state"], row["between_state"], row["between_region"]]
        assert sum(parts) == row["squares_total"] and row["n"] == len(own)
        x = [Fraction(round(r[4] * 100), 100) for r in own]
        mean = sum(x) / len(x)
        total = sum((v - mean) ** 2 for v in x)
        within = Fraction(0)
        for state in {r[2] for r in own}:
            some = [v for v, r in zip(x, own, strict=True) if r[2] == state]
            within += sum((v - sum(some) / len(some)) ** 2 for v in some)
        assert abs(Fraction(row["squares_total"]) - total) < Fraction(1, 10**8)
        assert abs(Fraction(row["within_state"]) - within) < Fraction(1, 10**8)
    whole = analyses.inequality(rates, "rate", ["state"]).first()
    assert whole["within_state"] + whole["between_state"] == whole["squares_total"]


def test_moments_merge(rates):
    fine = analyses.moments(rates, ["ano", "state"], "rate")
    merged = fine.groupBy("ano").agg(*[F.sum(c).cast("string").alias(c) for c in ("n", "total", "squares")])
    direct = analyses.moments(rates, ["ano"], "rate").select("ano", *[F.col(c).cast("string") for c in ("n", "total", "squares")])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))


def test_trend_is_least_squares(rates):
    found = {r["place"]: r for r in analyses.trend(rates, ["place"], "rate").collect()}
    assert found["lone"]["slope"] is None and found["lone"]["intercept"] is None and found["lone"]["n"] == 1
    for place in {r[1] for r in _valid()} - {"lone"}:
        own = [(r[0], Fraction(round(r[4] * 100), 100)) for r in _valid() if r[1] == place]
        n, sx, sy = len(own), sum(x for x, _ in own), sum(y for _, y in own)
        slope = (n * sum(x * y for x, y in own) - sx * sy) / Fraction(n * sum(x * x for x, _ in own) - sx * sx)
        assert found[place]["slope"] == pytest.approx(float(slope), rel=1e-12)
        assert found[place]["intercept"] == pytest.approx(float((sy - slope * sx) / n), rel=1e-12)


def test_risk(spark):
    fitted = spark.createDataFrame([("a", 2, 1.0, -1900.0), ("b", 1, None, None)], "place string, n bigint, slope double, intercept double")
    targets = spark.createDataFrame([("a", 1999, 98.0), ("a", 1999, 99.5), ("b", 1999, 1.0), ("c", 1999, 1.0)], "place string, target_year int, target double")
    found = sorted(map(tuple, analyses.at_risk(fitted, targets, ["place"]).collect()))
    assert found == [("a", 1999, 98.0, 99.0, False), ("a", 1999, 99.5, 99.0, True), ("b", 1999, 1.0, None, None), ("c", 1999, 1.0, None, None)]


def test_path_to_the_next_target_not_met(spark):
    wide = spark.createDataFrame(
        [("a", 50.0, 60.0, 70.0), ("b", None, 40.0, None), ("c", None, None, float("nan"))],
        "place string, meta_2001 double, meta_2002 double, meta_2004 double",
    )
    long = analyses.targets_long(wide, ["place"], "meta_")
    assert long.count() == 4
    rates = spark.createDataFrame(
        [(2000, "a", 45.0), (2000, "a", 50.0), (2001, "a", 30.0), (2002, "a", 60.01), (2004, "a", 1.0),
         (2000, "b", 40.0), (2000, "c", 1.0), (2000, "d", 1.0), (2000, "a", None)],
        "ano int, place string, rate double",
    )
    found = analyses.path_to_target(rates, long, ["place"], "rate")
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted([
        ("a", 2000, 45.0, 2001, 50.0, 5.0), ("a", 2000, 50.0, 2002, 60.0, 5.0), ("a", 2001, 30.0, 2002, 60.0, 30.0),
        ("a", 2002, 60.01, 2004, 70.0, 5.0), ("a", 2004, 1.0, None, None, None), ("b", 2000, 40.0, None, None, None),
        ("c", 2000, 1.0, None, None, None), ("d", 2000, 1.0, None, None, None), ("a", 2000, None, None, None, None),
    ], key=str)
    with pytest.raises(ValueError, match="meta_"):
        analyses.targets_long(rates, ["place"], "meta_")


def test_clusters_do_not_depend_on_partitions(spark):
    draw = random.Random(3)
    made = [(i, round(draw.gauss(30 * (i % 3), 3), 2), round(draw.gauss(9 * (i % 3), 1), 2)) for i in range(300)]
    made += [(900, None, 1.0), (901, float("nan"), 2.0)]
    frame = spark.createDataFrame(made, "id int, a double, b double")
    labels = [dict(map(tuple, analyses.clusters(frame.repartition(n), ["a", "b"], 3).select("id", "cluster").collect())) for n in (1, 5)]
    assert labels[0] == labels[1] and len(labels[0]) == 300
    assert all(labels[0][i] == i % 3 for i in range(300))
    assert analyses.clusters(frame.limit(0), ["a", "b"], 3).isEmpty()
    assert {r["cluster"] for r in analyses.clusters(frame, ["a"], 1).collect()} == {0}
    same = spark.createDataFrame([(i, 1.0) for i in range(5)], "id int, a double")
    assert len({r["cluster"] for r in analyses.clusters(same, ["a"], 2).collect()}) == 1


def test_sketches_of_slices(spark):
    rows = [(y, f"r{i % 5}", f"m{i % 3000}") for y in (1, 2) for i in range(9000)] + [(3, "r0", None)]
    table = spark.createDataFrame(rows, "ano int, region string, place string").repartition(4)
    sketches = distinct_sketches(table, ["ano", "region"], "place")
    assert sketches.count() == 11
    found = distinct_of_slices(sketches, ["ano"]).withColumn("exact", F.lit(3000)).filter("ano < 3")
    assert found.filter(~within_error(F.col("estimate"), F.col("exact"))).isEmpty() and found.count() == 2
    assert abs(distinct_of_slices(sketches).first()["estimate"] - 3000) < 200
    assert distinct_of_slices(sketches, ["ano"]).filter("ano = 3").first()["estimate"] == 0


def test_sample_is_the_same_whatever_the_partitions(spark):
    rows = [(i, "hot" if i % 10 else "cold", i * 2) for i in range(2000)] + [(5000, None, 1), (5001, "one", 1)]
    table = spark.createDataFrame(rows, "id int, s string, v int")
    got = [sorted(map(tuple, stratified_sample(table.repartition(n), ["s"], ["id"], 7).collect()), key=str) for n in (1, 6)]
    assert got[0] == got[1]
    sizes = {r[1]: r[3] for r in got[0]}
    assert sizes == {"hot": 1800, "cold": 200, None: 1, "one": 1} and len(got[0]) == 16
    plan = stratified_sample(table, ["s"], ["id"], 7)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_search_ignores_case_and_accents(spark):
    names = spark.createDataFrame([("São Paulo",), ("SAO JOSE",), ("Santos",), ("100% a_b",), (None,)], "n string")
    found = lambda q: sorted(r[0] for r in names.filter(contains_any_form(F.col("n"), q)).collect())
    assert found("sao") == ["SAO JOSE", "São Paulo"] and found("JOSÉ") == ["SAO JOSE"]
    assert found("%") == ["100% a_b"] and found("_b") == ["100% a_b"] and found("") == ["100% a_b", "SAO JOSE", "Santos", "São Paulo"]


def test_what_is_no_number_is_no_data(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([(nan, 1.0), (1.0, nan), (inf, 1.0), (2.0, 1.0), (0.5, 1.0), (None, None)], "v double, t double")
    got = [tuple(r) for r in frame.select(target_status(F.col("v"), F.col("t")), gap_to_target(F.col("v"), F.col("t"))).collect()]
    assert got == [("Sem dado", None), ("Sem meta", None), ("Sem dado", None), ("Atingida", 1.0), ("Abaixo", -0.5), ("Sem meta", None)]
