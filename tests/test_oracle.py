"""Every registered query against its SQL on the smallest tables; the others must give rows."""

import os

import oracle
import pytest
from parley import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
catalog.load()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_agrees_with_sql(spark, con, name):
    assert oracle.difference(catalog.QUERIES[name](spark, SF), con, catalog.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_gives_rows(spark, name):
    assert not catalog.QUERIES[name](spark, SF).isEmpty()


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
