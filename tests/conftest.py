from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metaloom.session import build_session  # noqa: E402


def local_session():
    session = build_session(
        "metaloom-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


# Columns are named at import time in the test modules, which needs a running session.
SESSION = local_session()


@pytest.fixture(scope="session")
def spark():
    return SESSION
