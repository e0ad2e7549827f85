"""Every query against its SQL, and those without SQL for rows."""

import pytest

from tests.conftest import DATA
from tessera import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_gives_what_its_sql_gives(spark, duck, same_rows, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert same_rows(got) == same_rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
