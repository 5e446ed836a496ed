import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from registry.compare import session

    session_ = session("8")
    yield session_
    session_.stop()


@pytest.fixture(scope="session")
def sf():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("test tables are not there")
    return str(folder)
