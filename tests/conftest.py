from __future__ import annotations

import os
import sys
import tempfile
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortscope.session import local_session  # noqa: E402
from cohortscope.study import Study  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def study():
    return Study(snapshot_date=date(2025, 1, 1))


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
