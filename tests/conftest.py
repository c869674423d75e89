"""One local session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tidegate.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidegate-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.sql.maxMetadataStringLength": "2000", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
