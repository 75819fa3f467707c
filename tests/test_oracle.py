"""Every registered query against its SQL twin at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle_check import TESTDATA, compare, connect

SF_DIR = f"{TESTDATA}/sf0.001"
# These hit nothing in the smallest tables; they are compared at larger scales.
MAY_BE_EMPTY = {"secret_hits_documents", "incremental_scan"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    status, _, note = compare(spark, con, name, SF_DIR, contract.queries(), contract.oracle_sql())
    allowed = {"ok", "rows-only"} | ({"empty"} if name in MAY_BE_EMPTY else set())
    assert status in allowed, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
