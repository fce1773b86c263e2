import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tidewater-tests")
    yield s
    s.stop()


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
