import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

"""Every registered query with SQL gives the same rows as the SQL."""

import pytest

import oracle
from trailmart.plans import catalog

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, data, name):
    oracle.compare(spark, con, catalog.queries()[name], SQL[name], data)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL) - {"qg_all_gates", "bi11_acceptance_status"}))
def test_query_without_sql_runs(spark, data, name):
    assert catalog.queries()[name](spark, data).columns
