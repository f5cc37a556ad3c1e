import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from annomill.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, "tests", **{
        "spark.checkpoint.dir": str(shared),
        "spark.sql.warehouse.dir": str(shared / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(frame, *columns):
    """Rows as sorted tuples, for comparison."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture(scope="session")
def as_rows():
    return rows
