"""Every registered query against its DuckDB oracle (small scale factor)."""

import pytest

import __spark_entry__ as entry
from cxlake.plans import oracle, queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = queries.registry()
ORACLE = oracle.oracle_statements()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_the_oracle_imports_nothing_of_the_engine():
    with open(oracle.__file__, encoding="utf-8") as f:
        assert not [line for line in f if line.lstrip().startswith(("import", "from ")) and "cxlake" in line]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF), ORACLE[name], con)
    assert res["columns_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["values_match"], res


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Mes", "Clasificacion", "Cantidad", "Suma_Total_CLP", "Promedio_CLP"]
