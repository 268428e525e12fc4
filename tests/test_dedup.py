import random

from pyspark.sql import functions as F

from terrace.operators.dedup import dedup_audit, deduplicate, without_key

SCHEMA = "k string, at string, v int, w string"


def test_latest_row_survives_whatever_the_order(spark, rows):
    data = [("a", "1", 5, "x"), ("a", "2", 1, "x"), ("a", "2", 1, "y"), ("b", "1", None, None)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        assert rows(deduplicate(df, ["k"], ["at"], "n")) == [
            ("a", "2", 1, "y", 3), ("b", "1", None, None, 1),
        ]


def test_same_columns_and_idempotent(spark, rows):
    df = spark.createDataFrame([("a", "1", 1, "x"), ("a", "1", 1, "x")], SCHEMA)
    once = deduplicate(df, ["k", "absent"], ["at"])
    assert once.columns == df.columns and once.dtypes == df.dtypes
    assert rows(deduplicate(once, ["k"], ["at"])) == rows(once)


def test_rows_without_key_are_set_aside_and_counted(spark, rows):
    lost = [(None, "1", 1, "x"), (None, "2", 2, "x"), (None, "2", 2, "x")]
    df = spark.createDataFrame([*lost, ("a", "1", 1, "x"), ("a", "2", 1, "x")], SCHEMA)
    assert rows(deduplicate(df, ["k", "absent"], ["at"], "n")) == [("a", "2", 1, "x", 2)]
    assert rows(without_key(df, ["k", "absent"])) == lost
    assert rows(dedup_audit(df, ["k"])) == [(5, 1, 1, 3)]


def test_no_key_no_change(spark):
    df = spark.createDataFrame([("a", "1", 1, "x")] * 2, SCHEMA)
    assert deduplicate(df, ["absent"]).count() == 2
    assert deduplicate(df, ["absent"], copies="n").first()["n"] == 1


def test_key_columns_only(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int")
    assert rows(deduplicate(df, ["k", "v"], copies="n")) == [("a", 1, 2)]


def test_audit(spark, rows):
    df = spark.createDataFrame([("a", "1", 1, "x")] * 3 + [("b", "1", 1, "x")], SCHEMA)
    assert rows(dedup_audit(df, ["k"])) == [(4, 2, 2, 0)]
    assert rows(dedup_audit(df.limit(0), ["k"])) == [(0, 0, 0, 0)]


def test_hot_key_is_reduced_before_the_shuffle(spark, rows, capsys):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, 30000, 1, 4).select(hot.alias("k"), F.col("id").alias("v"))
    kept = deduplicate(df, ["k"], copies="n")
    kept.explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan
    assert plan.index("Exchange") < plan.index("partial_max")
    assert rows(kept.filter("k = 0")) == [(0, 29997, 10000)]
    assert kept.count() == 20001
