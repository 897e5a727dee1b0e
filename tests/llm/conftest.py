import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import CLASHES, ODD_ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd_wide(odd):
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("own") for c in CLASHES if c != "n_chars"}).withColumn("n_chars", F.lit(-1).cast("long"))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module", autouse=True)
def nothing_cached(spark):
    """What the tests of a module cached is gone after it."""
    yield
    spark.catalog.clearCache()
