import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from shelfmark.session import SessionSpec, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        SessionSpec(
            app_name="tests",
            master="local[8]",
            extra={
                "spark.ui.enabled": "false",
                "spark.sql.shuffle.partitions": "8",
            },
        )
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
