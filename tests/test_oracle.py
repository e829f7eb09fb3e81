"""Every registered query that SQL can express gives what DuckDB gives on the same tables; the others give rows."""

import pytest

from tests.oracle import connect, rows
from weftline.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, con):
    found = QUERIES[name](spark, data).toPandas()
    if name not in SQL:
        assert len(found)
        return
    expected = con.execute(SQL[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)
