import os
import sys

import pytest
from pyspark import cloudpickle

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import fakes  # noqa: E402

cloudpickle.register_pickle_by_value(fakes)  # workers can't import the tests


@pytest.fixture(scope="session")
def spark():
    from quizmill.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
