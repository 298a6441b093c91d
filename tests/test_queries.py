"""Every registered query beside its check SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from registry.compare import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
# Long: the comparison is tested on a small frame in test_fits.py.
SLOW = {"compare_models"}


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["account_id", "day", "amount", "cls", "cls_default"]
    assert entry.entry(spark).count() > 0


def test_check_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, connection, folder, name):
    assert compare(spark, connection, folder, name, QUERIES[name], ORACLES.get(name)) == ""
