import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("riskloom-tests", "local[8]", 8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(tmp_path_factory):
    """A small set of raw tables in the two-round folder layout."""
    import raw_tables

    root = tmp_path_factory.mktemp("raw")
    return str(root), raw_tables.write(root)
