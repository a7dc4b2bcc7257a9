"""Every query that SQL can express gives what the SQL gives."""

import os

import pytest
from compare import connect, differences

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "pyspark-shell")

import __spark_entry__ as contract  # noqa: E402

ORACLES = contract.oracle_sql()
ROWS_ONLY = sorted(set(contract.queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(contract.queries()[name](spark, sf_dir), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_other_queries_give_rows(spark, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    assert result.columns == list(dict.fromkeys(result.columns))
    assert result.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
