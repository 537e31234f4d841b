import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(4, "riskloom-tests", **{
        "spark.checkpoint.dir": shared, "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TABLES
