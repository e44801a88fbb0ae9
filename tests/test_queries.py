import pytest

from guildbook.plans import registry
from tests.oracle import compare

SF = "/root/testdata/sf0.01"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    compare(spark, name, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, "/root/testdata/sf0.001").columns) > 0
