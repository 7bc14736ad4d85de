import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The tables are small, and some operators run many short jobs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
