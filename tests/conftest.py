import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardlight.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
