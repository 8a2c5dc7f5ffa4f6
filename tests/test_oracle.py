"""Every registered query with a SQL twin, on the smallest tables."""

from pathlib import Path

import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def twins():
    from __spark_entry__ import oracle_sql

    return oracle_sql()


@pytest.mark.parametrize("name", sorted(twins()))
def test_same_values(spark, con, name):
    from __spark_entry__ import queries

    ok, note = compare(spark, con, SF, queries()[name], twins()[name])
    assert ok, note
