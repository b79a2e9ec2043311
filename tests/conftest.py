import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortforge.session import local_session

    return local_session("tests", 8)


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("test tables not present")
    return DATA
