import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from callscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def at():
    """Shorthand for naive timestamps: ``at("2024-01-05 10:00")``."""
    return datetime.fromisoformat


@pytest.fixture
def folder(spark):
    from callscope.session import shared_folder

    return shared_folder(spark, "test")
