from terrace.contracts import CodeList, EntityContract
from terrace.operators import quality
from terrace.operators.clean import decode


def frame(spark):
    data = [(2023, "a", 1.0), (2024, "a", None), (2024, "b", None), (None, "b", 2.0)]
    return spark.createDataFrame(data, "ano int, id string, taxa double")


def test_report(spark, rows):
    found = rows(quality.quality_report(frame(spark), "e", ("ano", "taxa", "absent")))
    assert found == [
        ("e", "nulls", "ano", 1, 25.0, True),
        ("e", "nulls", "taxa", 2, 50.0, True),
        ("e", "rows", None, 4, None, False),
        ("e", "year", "2023", 1, None, False),
        ("e", "year", "2024", 2, None, False),
    ]


def test_report_without_a_year(spark, rows):
    found = quality.quality_report(frame(spark).drop("ano"), "e", ("id",))
    assert rows(found, "metric", "n", "warning") == [("nulls", 0, False), ("rows", 4, False)]


def test_counts(spark, rows):
    df = frame(spark)
    assert rows(quality.duplicate_keys(df, ["id"])) == [("a", 2), ("b", 2)]
    assert rows(quality.duplicate_keys(df, ["ano", "id"])) == []
    assert rows(quality.rows_and_ids(df, "id")) == [(4, 2)]
    assert rows(quality.rows_and_ids(df, "id", approximate=True)) == [(4, 2)]
    assert rows(quality.null_count(df, "taxa")) == [(2,)]
    assert rows(quality.row_counts({"x": df, "y": df.limit(0)})) == [("x", 4), ("y", 0)]
    assert rows(quality.status_distribution(df, "id")) == [("a", 2), ("b", 2)]
    assert rows(quality.status_distribution(df, "id", ["ano"]).filter("ano = 2024")) == [
        (2024, "a", 1), (2024, "b", 1),
    ]


def test_code_pairs(spark, rows):
    decoded = decode(frame(spark), CodeList("id", "label", (("a", "A"),)))
    assert rows(quality.code_pairs(decoded, "id", "label")) == [("a", "A"), ("b", "b")]


def test_checks(spark, rows):
    contract = EntityContract(name="e", keys=("id",), critical=("taxa", "absent"))
    assert rows(quality.table_checks(frame(spark), contract), "check", "found", "passed") == [
        ("has rows", 4, True), ("nulls in taxa", 2, False), ("repeated keys", 2, False),
    ]
    empty = quality.table_checks(frame(spark).limit(0), contract)
    assert rows(empty.filter("not passed"), "check", "level") == [("has rows", "error")]
    warnings = quality.table_checks(frame(spark), contract).filter("level = 'warning'")
    assert rows(warnings, "check") == [("nulls in taxa",)]
