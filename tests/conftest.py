import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from casetrail.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app_name="casetrail-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
