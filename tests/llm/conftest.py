import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from conftest_data import FIELDS, ODD, corpus


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), FIELDS).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, FIELDS).repartition(2).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], FIELDS)
