"""Every registered query beside its SQL, over all rows of the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload.check import compare, oracle
from workload.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "email", "name_first", "name_last", "course_home", "sign_up_source"]
    assert not df.isEmpty()
