"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, duck

from catalog.oracles import ORACLES
from catalog.queries import QUERIES

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows = queries()[name](spark, FOLDER)
    if name in oracle_sql():
        assert difference(rows, con, oracle_sql()[name]) is None
    else:
        rows.count()
