import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import build, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(build("tests", 8, 4))


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
