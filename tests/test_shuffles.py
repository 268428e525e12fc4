"""What is not shuffled on the way to the analytical table."""

from terrace.plans import literacy as L
from terrace.plans import star
from terrace.plans.analytical import GRAIN, analytical_table


def _star(spark, where):
    lines = [
        (o, o % 9, o % 5, o % 8, o % 30 + 0.0, 10.0 * o, "ANR"[o % 3], "OF"[o % 2], f"{1996 + o % 3}-05-01")
        for o in range(200)
    ]
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_returnflag l_linestatus l_shipdate"
    tables = {
        "lineitem": spark.createDataFrame(lines, names.split()),
        "supplier": spark.createDataFrame([(s, f"S{s}", s % 3) for s in range(5)], ["s_suppkey", "s_name", "s_nationkey"]),
        "nation": spark.createDataFrame([(n, f"N{n}", n % 2) for n in range(3)], ["n_nationkey", "n_name", "n_regionkey"]),
        "region": spark.createDataFrame([(r, f"R{r}") for r in range(2)], ["r_regionkey", "r_name"]),
    }
    for name, table in tables.items():
        table.write.parquet(f"{where}/{name}.parquet")
    return str(where)


def test_a_scratch_table_is_written_as_its_rows_lie(spark, tmp_path):
    where = _star(spark, tmp_path)
    four = lambda: spark.range(0, 40, 1, 4).selectExpr("id", "1997 AS ano")
    table = star.written_once(spark, where, "four", four)
    assert (table.count(), len(table.inputFiles())) == (40, 4)  # one if they were shuffled by year


def test_student_metrics_join_last_and_once_a_row(spark, tmp_path):
    tables = star.conformed(spark, _star(spark, tmp_path))
    table = analytical_table(tables, star.COMPOSITES)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    outermost = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert all(f"{c}#" in outermost for c in GRAIN)
    assert table.count() == tables[L.MUNICIPAL_RESULT].count()
    assert table.filter("alunos_total IS NULL").isEmpty()
