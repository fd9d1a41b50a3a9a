import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows and a schema as a DataFrame of two partitions."""
    def make(rows, schema, parts=2):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
