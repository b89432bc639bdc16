"""Every query that SQL can express gives the SQL's rows."""

import checker
import pytest

import __spark_entry__ as entry_module

ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def connection(folder):
    return checker.duck(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, folder, name):
    assert checker.compare(spark, connection, folder, QUERIES[name], ORACLES[name]) is None


def test_entry_reports_ten_metrics_for_three_splits(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 30 and all(isinstance(r["value"], float) for r in rows)
