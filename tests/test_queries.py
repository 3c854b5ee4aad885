"""Every registered query against its SQL counterpart."""

import re

import pytest
from compare import difference, duck
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None


def test_every_query_has_sql():
    """Those of the training-text operators have tests of their own where SQL cannot express them."""
    without = set(queries()) - set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in without)


def test_entry(spark):
    assert entry(spark).count() > 0
