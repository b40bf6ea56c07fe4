from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jsonflow.session import local_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def session():
    spark = local_session("4")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def spark(session):
    return prepare(session)


@pytest.fixture
def texts(spark):
    """A frame of messages ``value`` numbered by ``id``, in the order given."""

    def make(*values, partitions=2):
        rows = list(enumerate(values))
        return spark.createDataFrame(rows, "id int, value string").repartition(partitions)

    return make
