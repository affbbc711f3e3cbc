import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from foldwise.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="foldwise-tests")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF001
