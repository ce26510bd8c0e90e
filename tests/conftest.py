import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quire.session import local_session

    session = local_session(cores=8, memory="6g", partitions=8)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="quire-case-")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
