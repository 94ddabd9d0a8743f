import pytest

from tests.llm.brute import SCHEMA, rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """The same with repeated rows and null ids."""
    return spark.createDataFrame(rows() + rows()[:3] + [(None, *r[1:]) for r in rows()[:2]], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
