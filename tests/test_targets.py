import pytest
from pyspark.sql import functions as F

from terrace.contracts import Slice, StatusSpec
from terrace.functions.slices import apply_slice
from terrace.functions.targets import (
    STATUS_ORDER,
    status_rank,
    target_of_year,
    target_status,
    yearly_columns,
)
from terrace.functions.text import contains_text
from terrace.plans.analytical import add_statuses


def test_yearly_columns():
    names = ["meta_2025", "meta_2024", "meta_x", "meta_", "other_2024"]
    assert yearly_columns(names, "meta_") == {2024: "meta_2024", 2025: "meta_2025"}


def test_target_of_the_row_s_year(spark, rows):
    df = spark.createDataFrame(
        [(2023, 1.0, 2.0), (2024, 1.0, 2.0), (2025, 1.0, None), (None, 1.0, 2.0)],
        "ano int, m_2024 double, m_2025 double",
    )
    picked = df.select("ano", target_of_year(df.columns, "m_", F.col("ano")).alias("t"))
    assert rows(picked) == [(2023, None), (2024, 1.0), (2025, None), (None, None)]
    assert rows(df.limit(1).select(target_of_year(["ano"], "m_", F.col("ano")))) == [(None,)]


@pytest.mark.parametrize(
    ("value", "target", "status"),
    [
        (None, None, "Sem meta"),
        (50.0, None, "Sem meta"),
        (None, 50.0, "Sem dado"),
        (50.0, 50.0, "Atingida"),
        (49.99, 50.0, "Abaixo"),
    ],
)
def test_status(spark, rows, value, target, status):
    df = spark.createDataFrame([(value, target)], "v double, t double")
    assert rows(df.select(target_status(F.col("v"), F.col("t")))) == [(status,)]


def test_status_is_left_out_without_its_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "v double, t double")
    specs = [StatusSpec("f", "v", "t"), StatusSpec("g", "v", "absent")]
    assert add_statuses(df, specs).columns == ["v", "t", "f"]


def test_status_order(spark):
    df = spark.createDataFrame([(s,) for s in reversed(STATUS_ORDER)], "s string")
    ordered = df.orderBy(status_rank(F.col("s"))).collect()
    assert tuple(r["s"] for r in ordered) == STATUS_ORDER


def test_slice_values_are_values(spark, rows):
    data = [(2024, "3", "O'Higgins"), (2023, "3", "x")]
    df = spark.createDataFrame(data, "ano int, rede string, nome_regiao string")
    assert rows(apply_slice(df, Slice(region="O'Higgins")), "ano") == [(2024,)]
    assert apply_slice(df, Slice(region="x' OR '1'='1")).count() == 0
    assert apply_slice(df, Slice()) is df


def test_search_has_no_wildcards(spark, rows):
    df = spark.createDataFrame([("São João",), ("100% Real",), ("a_b",)], "n string")
    assert rows(df.filter(contains_text(F.col("n"), "JOÃO"))) == [("São João",)]
    assert rows(df.filter(contains_text(F.col("n"), "%"))) == [("100% Real",)]
    assert rows(df.filter(contains_text(F.col("n"), "_"))) == [("a_b",)]
