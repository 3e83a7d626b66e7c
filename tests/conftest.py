import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quaylake.session import local_session

    session = local_session(cores=8, shuffle_partitions=8, app="quaylake-tests")
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="quaylake-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def _sorted(out):
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


def rows(df):
    """Sorted list of row tuples (columns in DataFrame order)."""
    return _sorted([tuple(r) for r in df.collect()])


def rows_by_name(df):
    """Sorted list of row tuples with columns ordered by name."""
    cols = sorted(df.columns)
    return _sorted([tuple(r) for r in df.select(*cols).collect()])
