"""Every registered query against an independent engine on the smallest given tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from terrace.plans.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables not there")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for file in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, rows, engine, name):
    df = QUERIES[name](spark, DATA)
    result = engine.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(df.columns)
    order = [list(types).index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert rows(df, *columns) == sorted(expected, key=key)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
