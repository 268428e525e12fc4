"""Every registered corpus query on the smallest given tables; against SQL where there is SQL."""

import glob
import os

import duckdb
import pytest

from terrace.llm.oracle import ORACLE
from terrace.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables not there")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for file in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, engine, name):
    df = QUERIES[name](spark, DATA)
    result = engine.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(df.columns)
    order = [list(types).index(c) for c in columns]
    key = lambda t: tuple((v is None, str(v)) for v in t)
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=key)
    assert sorted(map(tuple, df.select(*columns).collect()), key=key) == expected


PER_DOCUMENT = sorted(q for q in set(QUERIES) - set(ORACLE) - {"pipeline"})


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_a_row_for_every_document(spark, engine, name):
    found = [r["doc_id"] for r in QUERIES[name](spark, DATA).select("doc_id").collect()]
    assert sorted(found) == [r[0] for r in engine.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]
