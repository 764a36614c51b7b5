import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shiftlake.session import local_session, prepare


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session(4, "6g"))
    yield session
    session.stop()
