import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import SCHEMA, awkward, frame  # noqa: E402


@pytest.fixture(scope="session")
def hard(spark):
    return frame(spark, awkward()).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
