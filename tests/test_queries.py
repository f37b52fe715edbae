"""Every registered query with SQL gives the same columns and rows in both engines."""

from __future__ import annotations

import pytest

from tabspark.plans import ORACLES, QUERIES

from .oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
