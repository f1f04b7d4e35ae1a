"""Every registered query against its SQL, over the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entries  # noqa: E402
from checks import compare  # noqa: E402
from checks.oracle import ORACLE  # noqa: E402
from checks.queries import registered  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(registered()) == set(ORACLE)
    assert set(ORACLE) <= set(entries.oracle_sql()) and set(registered()) <= set(entries.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare.compare(spark, connection, FOLDER, name) is None


def test_entry(spark):
    assert entries.entry(spark).count() == 697
