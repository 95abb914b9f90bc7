from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opine.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, shuffle_partitions=8, checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.01")
