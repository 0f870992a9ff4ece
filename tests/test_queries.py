"""Every query of the library's own operators against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

#: Checks that rightly find nothing on the smallest data set.
MAY_BE_EMPTY = {"duplicate_user_days", "accept_violations", "infra_languages", "missing_members"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    problem = difference(spark, duck, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert problem is None or problem == "no rows" and name in MAY_BE_EMPTY


def test_entry(spark):
    assert entry_module.entry(spark).count() == 30


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
