import pytest

LONG = "thing of the word " * 30_000  # over half a million characters


@pytest.fixture(scope="session")
def frame(spark):
    """Rows with a schema, dealt over several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)

    return make
