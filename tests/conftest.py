import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vitrine.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a frame, for comparison."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)
