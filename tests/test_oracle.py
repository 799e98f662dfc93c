"""Every catalogue query against its SQL on DuckDB."""

import sys
from pathlib import Path

import oracle
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_points  # noqa: E402

from ledgerloom import catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_each_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = oracle.difference(
        entry_points.queries()[name](spark, FOLDER), duck, entry_points.oracle_sql()[name]
    )
    assert found is None, found


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1000
