import pytest
from pyspark.sql import functions as F

from terrace.contracts import Dimension
from terrace.operators.joins import (
    add_columns,
    add_dimension,
    join_coverage,
    orphans,
)
from terrace.sources.dimensions import conform_dimension

PLACES = Dimension("places", "id", (("code", "id"), ("name", "nome")))


def test_dimension_has_one_trimmed_row_per_key(spark, rows):
    raw = spark.createDataFrame(
        [(" 01", "B "), ("01", "A"), ("02 ", None)], "code string, name string"
    )
    assert rows(conform_dimension(raw, PLACES)) == [("01", "B"), ("02", None)]


def test_numeric_ids_become_text(spark, rows):
    raw = spark.createDataFrame([(7, "A")], "code int, name string")
    assert rows(conform_dimension(raw, PLACES)) == [("7", "A")]


def test_unmatched_rows_stay(spark, rows):
    fact = spark.createDataFrame([("1", 10), ("9", 20), (None, 30)], "id string, v int")
    dim = spark.createDataFrame([("1", "A")], "id string, nome string")
    assert rows(add_dimension(fact, PLACES, {"places": dim})) == [
        ("1", 10, "A"), ("9", 20, None), (None, 30, None),
    ]
    assert add_dimension(fact, None, {}) is fact
    assert add_dimension(fact.drop("id"), PLACES, {"places": dim}).columns == ["v"]


def test_hot_key_is_split_beyond_the_broadcast_bound(spark, capsys):
    """A third of the rows has one key; the join must not leave them to one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    fact = spark.range(0, 60000, 1, 8).select(hot.alias("k"), F.col("id").alias("v"))
    right = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = add_columns(fact, right, ["k"], "right")
        assert len(joined.collect()) == 60000
        joined.explain()
        plan = capsys.readouterr().out
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_repeated_key_on_the_right_fails(spark, rows):
    base = spark.createDataFrame([("1", 1)], "id string, v int")
    right = spark.createDataFrame([("1", 5), (None, 6), (None, 7)], "id string, w int")
    assert rows(add_columns(base, right, ["id"], "targets")) == [("1", 1, 5)]
    twice = right.unionByName(right)
    with pytest.raises(Exception, match="targets has several rows for id = 1"):
        add_columns(base, twice, ["id"], "targets").collect()
    assert add_columns(base, None, ["id"], "targets") is base


def test_coverage(spark, rows):
    fact = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "id string")
    dim = spark.createDataFrame([("1",), ("1",), ("3",)], "id string")
    assert rows(join_coverage(fact, dim, "id")) == [(4, 2, 2, 2)]
    assert rows(orphans(fact, dim, "id")) == [("2", 1), (None, 1)]
    assert rows(join_coverage(fact.limit(0), dim, "id")) == [(0, 0, 0, 0)]
