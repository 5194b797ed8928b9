import pytest

from cairnfield import queries
from tests.compare import duck_rows, spark_rows


#: Held against plain Python in test_cells instead.
WITHOUT_SQL = {"segments_watershed", "object_solidity"}


def test_queries_without_sql():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_rows_equal_the_sql(spark, sf, name):
    got = spark_rows(queries.QUERIES[name](spark, sf))
    assert got == duck_rows(queries.ORACLES[name], sf)


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
