from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opsloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="opsloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
