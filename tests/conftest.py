import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, str(type(x)), x) for x in r])
