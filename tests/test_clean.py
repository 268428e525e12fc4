import pytest
from pyspark.sql import functions as F

from terrace.contracts import CodeList, EntityContract
from terrace.functions.text import snake_name
from terrace.operators.clean import (
    blanks_to_null,
    cast_by_contract,
    decode,
    standard_names,
    type_payload,
)
from terrace.plans import literacy as L


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Município", "municipio"),
        (" Taxa (%) de  Alfabetização ", "taxa_de_alfabetizacao"),
        ("_Ingestão Data", "_ingestao_data"),
        ("__dupla__", "_dupla"),
        ("ANO", "ano"),
        ("2º ano", "2o_ano"),
    ],
)
def test_snake_name(raw, clean):
    assert snake_name(raw) == clean


def test_name_without_letters_is_an_error():
    with pytest.raises(ValueError):
        snake_name("(%)")


def test_names_that_clash_are_an_error(spark):
    with pytest.raises(ValueError, match="acao"):
        standard_names(spark.createDataFrame([(1, 2)], ["Ação", "acao"]))


def test_blanks(spark, rows):
    data = [("  a ", "", " x ", 1), ("   ", None, "", 2)]
    df = spark.createDataFrame(data, "a string, b string, _t string, n int")
    assert rows(blanks_to_null(df)) == [("a", None, " x ", 1), (None, None, "", 2)]


def test_cast_keeps_leading_zeros_and_turns_misfits_to_null(spark, rows):
    df = spark.createDataFrame(
        [("007", "2024.0", "1.5", "70"), ("008", "x", "abc", ""), (None, "3.7", "2", "1e2")],
        "id string, ano string, taxa string, meta_alfabetizacao_2024 string",
    )
    contract = EntityContract(
        name="t",
        keys=("id",),
        integers=("ano", "not_there"),
        doubles=("taxa",),
        texts=("id",),
        double_prefixes=("meta_alfabetizacao_",),
    )
    cast = cast_by_contract(df, contract)
    assert [t for _, t in cast.dtypes] == ["string", "int", "double", "double"]
    assert rows(cast) == [
        ("007", 2024, 1.5, 70.0), ("008", None, None, None), (None, 3, 2.0, 100.0),
    ]


def test_cast_numbers_to_text(spark, rows):
    contract = EntityContract(name="t", keys=(), texts=("id",), integers=("n",))
    df = spark.createDataFrame([(7, 2.0)], "id bigint, n double")
    assert rows(cast_by_contract(df, contract)) == [("7", 2)]


def test_decode(spark, rows):
    df = spark.createDataFrame([("3",), ("9",), ("Pública",), (None,)], "rede string")
    assert rows(decode(df, L.NETWORKS)) == [
        ("3", "Municipal"), ("9", "9"), ("Pública", "Pública"), (None, None),
    ]
    assert decode(df, CodeList("absent", "label", (("1", "x"),))).columns == ["rede"]


def test_payload_types(spark, rows):
    df = spark.createDataFrame(
        [("1", "1", "760.5", ""), ("", "x", "", None)],
        "preenchimento_caderno string, alfabetizado string, proficiencia string, peso_aluno string",
    )
    typed = type_payload(df, L.STUDENT_PAYLOAD)
    assert [t for _, t in typed.dtypes] == ["double", "int", "double", "double"]
    assert rows(typed) == [(1.0, 1, 760.5, None), (None, None, None, None)]


def test_cleaning_is_one_projection(spark, capsys):
    df = spark.range(1).select(*[F.lit(" x ").alias(f"c{i}") for i in range(30)])
    blanks_to_null(df).explain(True)
    assert capsys.readouterr().out.split("Optimized Logical Plan")[1].count("Project") <= 2
