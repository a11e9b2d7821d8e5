from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


@pytest.fixture(scope="session")
def oracle(folder):
    from verify import duck

    return duck(folder)
