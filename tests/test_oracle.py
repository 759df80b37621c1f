"""Every query against its SQL; queries without SQL must give rows."""

import oracle
import pytest
from stationkit.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    query = QUERIES[name]
    columns, rows = oracle.actual(query.run(spark, FOLDER))
    assert columns
    if query.sql is None:
        assert rows
    else:
        assert (columns, rows) == oracle.expected(con, query.sql)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1000
    assert set(entry.oracle_sql()) <= set(entry.queries())
