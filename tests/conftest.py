import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    from skillframe.session import configure

    return configure(session())


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
