"""Every registered query against its SQL in DuckDB, on whole tables of the smallest scale."""

import pathlib

import pytest

import workload.all_queries  # noqa: F401
from workload.compare import compare, connect
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, name) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(ORACLES) > 90
