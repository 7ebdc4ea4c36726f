import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

@pytest.fixture(scope="session")
def awkward(spark):
    import brute

    return spark.createDataFrame(brute.awkward(), brute.SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark, awkward):
    return spark.createDataFrame([], awkward.schema)


@pytest.fixture(scope="session")
def small_docs(spark):
    import brute

    return spark.read.parquet(f"{brute.SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def small_rows(small_docs):
    return [tuple(r) for r in small_docs.collect()]
