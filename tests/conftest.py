import os
import sys

import pytest  # noqa: F401

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from labelloom.session import local_session
    return local_session(8, partitions=4, memory="6g")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
