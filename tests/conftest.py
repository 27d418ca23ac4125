import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("shelfwise-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfwise-test-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shelfwise-warehouse-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Result rows as a sorted list of tuples."""
    def take(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return take
