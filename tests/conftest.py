import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pressmill.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.shuffle.partitions": "4"})
    ship_package(session)
    yield session
    session.stop()
