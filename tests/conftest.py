from __future__ import annotations

import os
import time

import pytest

from stream_commerce.config import session_builder
from tests.compare import connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = (
        session_builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return FOLDER


@pytest.fixture(scope="session")
def con():
    return connect(FOLDER)


@pytest.fixture
def feed(tmp_path):
    """Write message files that a stream reads one per batch, in the order they were written."""
    path = tmp_path / "feed"
    path.mkdir()
    state = {"n": 0}

    def write(*messages: str, name: str = "feed") -> str:
        target = tmp_path / name
        target.mkdir(exist_ok=True)
        state["n"] += 1
        part = target / f"{state['n']:05d}.txt"
        part.write_text("\n".join(messages) + "\n")
        stamp = time.time() - 3600 + state["n"]
        os.utime(part, (stamp, stamp))
        return str(target)

    return write
