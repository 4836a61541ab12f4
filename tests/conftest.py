import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from urbanframe.session import local_session

    session = local_session(cpus=4, shuffle_partitions=4, memory="4g", app="urbanframe-tests")
    yield session
    session.stop()
