"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from parity import compare, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    problem = compare(spark, con, FOLDER, entry.queries()[name], SQL.get(name))
    # Some predicates select nothing on the smallest tables.
    assert problem in (None, "no rows")


def test_every_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_registry_needs_no_session():
    """Queries and SQL can be listed before any session exists."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=60)
