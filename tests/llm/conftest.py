import os

import pytest

from tests.llm.llm_helpers import DOCUMENTS, corpus

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def on_workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
