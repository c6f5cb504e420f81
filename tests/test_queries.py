"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_point  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
assert os.path.isdir(SF), "no test tables"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, con, name):
    text, same = compare(spark, con, SF, name, entry_point.queries()[name], entry_point.oracle_sql().get(name))
    assert same, text


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
