import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("CORPUSMILL_DRIVER_MEMORY", "3g")


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import build_session, ship_package

    session = build_session("local[4]", shuffle_partitions=4)
    ship_package(session)
    yield session
    session.stop()
