import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *cols):
    """Rows as sorted tuples."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda t: tuple((x is None, str(type(x)), x) if not isinstance(x, (int, float)) else (False, "n", x) for x in t))
