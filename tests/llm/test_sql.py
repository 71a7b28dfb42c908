"""The registered queries against their SQL in an independent engine, hashes included."""

import pytest
from compare import connect, spark_rows, sql_rows

from skytally.llm import queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    found_columns, found = spark_rows(queries.queries()[name](spark, sf_dir))
    wanted_columns, wanted = sql_rows(duck, queries.oracle_sql()[name])
    assert found_columns == wanted_columns
    assert len(found) == len(wanted) > 0
    assert found == wanted
