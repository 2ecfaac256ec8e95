import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell import build_session, release_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "8"})
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(autouse=True)
def _clean(request):
    yield
    if "spark" in request.fixturenames:
        release_scratch(request.getfixturevalue("spark"))
