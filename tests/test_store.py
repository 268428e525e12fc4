from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.catalog import column_names, has_columns, register
from terrace.sources.csv import entity_of_path, file_path, read_csv, rejected_rows, valid_rows
from terrace.sources.layers import MissingInput, Store, export_csv, write_layer
from terrace.sources.scratch import scratch_path

SCHEMA = T.StructType(
    [
        T.StructField("ano", T.IntegerType()),
        T.StructField("id", T.StringType()),
        T.StructField("taxa", T.DoubleType()),
    ]
)


def csv(tmp_path, *lines, name="br_x_entidade.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_values_and_nulls(spark, rows, tmp_path):
    path = csv(tmp_path, "ano,id,taxa", '2024,"007, São",1.5', "2024,,", ',"",2')
    df = read_csv(spark, path, SCHEMA)
    assert rows(valid_rows(df)) == [(2024, "007, São", 1.5), (2024, None, None), (None, None, 2.0)]
    assert rejected_rows(df).count() == 0


def test_csv_rejects_bad_values_short_and_long_rows(spark, rows, tmp_path):
    path = csv(tmp_path, "ano,id,taxa", "2024,a,x", "2024,b", "2024,c,1,9", "2024,d,1")
    df = read_csv(spark, path, SCHEMA)
    assert rows(valid_rows(df)) == [(2024, "d", 1.0)]
    kept = rows(rejected_rows(df), "_corrupt_record")
    assert kept == [("2024,a,x",), ("2024,b",), ("2024,c,1,9",)]
    assert rows(valid_rows(df), "id") == [("d",)]
    assert (valid_rows(df).count(), rejected_rows(df).count()) == (1, 3)


@pytest.mark.parametrize("header", ["ano,codigo,taxa", "id,ano,taxa", "ano,id"])
def test_csv_header_must_match(spark, tmp_path, header):
    path = csv(tmp_path, header, "2024,a,1")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, SCHEMA).collect()


def test_entity_of_file(spark, rows, tmp_path):
    path = csv(tmp_path, "ano,id,taxa", "2024,a,1")
    df = read_csv(spark, path, SCHEMA).select(entity_of_path(file_path(), "br_x_"))
    assert rows(df) == [("entidade",)]


def years(spark, *pairs):
    return spark.createDataFrame(pairs, "ano int, v string")


def test_only_present_partitions_are_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = write_layer(years(spark, (2023, "a"), (2024, "b"), (2024, "c")), path)
    assert first == {"rows": 3, "columns": 2}
    write_layer(years(spark, (2024, "d")), path)
    assert rows(spark.read.parquet(path), "ano", "v") == [(2023, "a"), (2024, "d")]
    write_layer(years(spark, (2024, "e")), path, replace_all=True)
    assert rows(spark.read.parquet(path), "ano", "v") == [(2024, "e")]


def test_without_partition_column(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a",)], "v string")
    for _ in range(2):
        write_layer(df, path, compact=True)
    assert rows(spark.read.parquet(path)) == [("a",)]


def test_null_partition_is_kept(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_layer(years(spark, (None, "a"), (2024, "b")), path)
    assert rows(spark.read.parquet(path), "ano", "v") == [(2024, "b"), (None, "a")]


def test_watch_and_hide(spark, tmp_path):
    path = str(tmp_path / "t")
    df = years(spark, (2023, None), (2024, "b")).withColumn("n", F.lit(2))
    watch = [F.sum("n").alias("before"), F.count_if(F.col("v").isNull()).alias("nulls")]
    figures = write_layer(df, path, watch=watch, hide=["n"])
    assert figures == {"rows": 2, "before": 4, "nulls": 1, "columns": 2}
    assert spark.read.parquet(path).columns == ["v", "ano"]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_layer(years(spark, (2023, "a")).limit(0), path)["columns"] == 2


def test_hot_year_is_split_over_files_and_small_ones_are_not(spark, tmp_path):
    """A year with most of the rows must not be written by one task."""
    path = str(tmp_path / "t")
    hot = F.when(F.col("id") % 20 == 0, F.col("id") % 3 + 2021).otherwise(2024)
    df = spark.range(0, 400_000, 1, 8).select(
        hot.cast("int").alias("ano"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        assert write_layer(df, path, compact=True)["rows"] == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {y: len(list((tmp_path / "t" / f"ano={y}").glob("*.parquet"))) for y in (2021, 2024)}
    assert files[2021] == 1 and files[2024] > 2


def test_optional_and_required_inputs(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    write_layer(years(spark, (2024, "a")), store.path("silver", "here"))
    assert list(store.read_present("silver", ["here", "gone"])) == ["here"]
    with pytest.raises(MissingInput, match="gone"):
        store.read_present("silver", ["here", "gone"], ["gone"])
    with pytest.raises(MissingInput, match="never"):
        store.read_present("silver", ["here"], ["never"])


def test_year_filter_prunes_partitions(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    write_layer(years(spark, (2023, "a"), (2024, "b")), path)
    spark.read.parquet(path).filter(F.col("ano") == 2024).select("v").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(ano" in plan
    assert "ReadSchema: struct<v:string>" in plan


def test_register_finds_partitions_again(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(years(spark, (2023, "a")), path)
    register(spark, "db_test", "silver", "t", path)
    write_layer(years(spark, (2024, "b")), path)
    name = register(spark, "db_test", "silver", "t", path)
    assert name == "`db_test`.`silver_t`"
    assert column_names(spark, name) == ["v", "ano"]
    assert spark.table(name).count() == 2
    assert has_columns(spark.table(name), "ano", "v") and not has_columns(spark.table(name), "x")


def test_csv_export_reads_back(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "", 1.5)], "n int, t string, x double")
    export_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "out"))
    assert rows(back.select("n", "x")) == [(1, None), (2, 1.5)]


def session(master, **settings):
    """Stands in for a session with these settings, which a running one cannot change."""
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(
        conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app")
    )


def test_scratch_follows_the_session():
    shared = session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared"})
    first, second = scratch_path(shared, "x"), scratch_path(shared, "x")
    assert first.startswith("hdfs://shared/terrace/app/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "x")
    assert "terrace-" in scratch_path(session("local[2]"), "x")


def test_a_managed_table_is_left_as_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    spark.range(5).write.mode("overwrite").saveAsTable("kept.silver_t")
    with pytest.raises(ValueError, match="not external"):
        register(spark, "kept", "silver", "t", path)
    assert spark.table("kept.silver_t").count() == 5
    spark.sql("DROP TABLE kept.silver_t")
    name = register(spark, "kept", "silver", "t", path)
    assert register(spark, "kept", "silver", "t", path) == name
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")
