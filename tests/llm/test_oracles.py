import pytest

from tessera.llm import queries
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_gives_what_its_sql_gives(spark, duck, same_rows, name):
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert same_rows(got) == same_rows(want)
