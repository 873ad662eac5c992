"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import subprocess
import sys

import pytest

from parity.catalog import QUERIES
from parity.compare import compare, connect
from parity.oracles import ORACLES
from tests.conftest import ROOT


@pytest.fixture(scope="module")
def duckdb_tables(small):
    return connect(small)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_rows_match(spark, duckdb_tables, small, name):
    found = compare(spark, duckdb_tables, small, name)
    assert found["rows"] == found["expected_rows"]
    assert not found["names_differ"]
    assert not found["types_differ"]
    assert not found["only_ours"] and not found["only_expected"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n.endswith("in_parts")])
def test_rows_match_where_groups_are_cut(spark, medium, name):
    """Larger tables, as the groups of the small ones fit a task."""
    found = compare(spark, connect(medium), medium, name)
    assert found["rows"] == found["expected_rows"]
    assert not found["only_ours"] and not found["only_expected"]


def test_entry_point_imports_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries().keys() >= e.oracle_sql().keys()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
