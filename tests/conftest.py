import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from check import session

    found = session(partitions=4)
    yield found
    found.stop()


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
