from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from lakeweir import session

    built = session.build(
        "tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="lakeweir-tests-"),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
