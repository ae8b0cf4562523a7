from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from readloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "readloom-tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture
def reads_of(spark):
    """Reads from (header, bases, qual) triples."""
    return lambda rows: spark.createDataFrame(rows, "header string, bases string, qual string")
