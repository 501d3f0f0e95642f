import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session

    s = build_session("local[4]", app_name="ledgerlens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def lines(spark):
    """Turn a list of raw text lines into a ``value`` frame, as read from a file."""

    def make(rows, partitions=2):
        df = spark.createDataFrame([(r,) for r in rows], "value string")
        return df.repartition(partitions) if partitions else df

    return make
