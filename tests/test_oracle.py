"""Every registered query against its SQL in an independent engine."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as driver
from skytally.plans.oracles import oracle_sql
from skytally.plans.queries import queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    found_columns, found = spark_rows(driver.queries()[name](spark, sf_dir))
    wanted_columns, wanted = sql_rows(duck, SQL[name])
    assert found_columns == wanted_columns
    assert len(found) == len(wanted) > 0
    assert found == wanted


def test_every_query_has_sql():
    assert set(queries()) == set(SQL)
    assert SQL.items() <= driver.oracle_sql().items() and queries().keys() <= driver.queries().keys()


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[0] == "GRAIN"
    assert result.count() > 0


def test_line_items_have_all_their_rows(duck):
    """The view leaves tables out that supply no column; that needs complete foreign keys."""
    for key, table, target in (
        ("l_orderkey", "orders", "o_orderkey"),
        ("l_partkey", "part", "p_partkey"),
        ("l_suppkey", "supplier", "s_suppkey"),
    ):
        missing = f"SELECT count(*) FROM lineitem WHERE {key} NOT IN (SELECT {target} FROM {table}) OR {key} IS NULL"
        assert duck.execute(missing).fetchall() == [(0,)]
        double = f"SELECT count(*) - count(DISTINCT {target}) FROM {table}"
        assert duck.execute(double).fetchall() == [(0,)]
    chain = "SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    assert duck.execute(chain).fetchall() == duck.execute("SELECT count(*) FROM orders").fetchall()
