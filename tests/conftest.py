import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedmark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("feedmark-tests", "4")


@pytest.fixture
def at():
    """``at(day, hour)`` in January 2024."""
    return lambda day, hour=0: datetime(2024, 1, day, hour)
