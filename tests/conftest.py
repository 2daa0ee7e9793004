"""One local session for all tests."""

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from curlew.session import local_session, release

    session = local_session(4, app="tests")
    yield session
    release(session)
    session.stop()
