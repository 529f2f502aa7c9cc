import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows -> frame, by a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
