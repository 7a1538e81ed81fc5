"""Every query of the catalogue against its SQL counterpart, on whole tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences

from codequarry.plans.catalog import QUERIES
from codequarry.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
