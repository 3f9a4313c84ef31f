"""Every registered query against its SQL equivalent, on the smallest given tables."""

import pytest
from compare import check, duck

from laborlens.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, SF, name) is None


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 25 * 32
