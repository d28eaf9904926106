from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from meterlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        "meterlake-tests",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "checkpoints"),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("METERLAKE_TEST_DATA", "/root/testdata/sf0.001")
