import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SF_BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark, shared_root

    s = get_spark(app="tidemark-tests", cpus="*", shuffle_partitions=8, driver_memory="8g")
    shared_root(s)
    yield s


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
