"""Every query with SQL gives the rows of that SQL; the others run."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    status, detail, _ = compare(spark, db, name, SF)
    assert status in ("ok", "rows"), detail


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
