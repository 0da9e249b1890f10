"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# The corpus operators have tests of their own.
NAMES = sorted(n for n in entry.queries() if n.startswith("q_"))


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None
