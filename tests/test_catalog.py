import pytest

import __spark_entry__ as contract
from ratewise.plans.catalog import QUERIES
from tests import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return compare.database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    assert compare.compare(spark, database, name, FOLDER) is None


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_of_the_catalog_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_comparison_sees_a_wrong_value(spark, database, monkeypatch):
    wrong = {"row_count": 'SELECT CAST(1 AS BIGINT) AS "rows"'}
    monkeypatch.setattr(compare, "oracle_sql", lambda: wrong)
    assert "differ" in compare.compare(spark, database, "row_count", FOLDER)


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
