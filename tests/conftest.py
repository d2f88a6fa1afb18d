import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect  # noqa: E402
from formsift.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "formsift-tests", **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="session")
def small():
    return SMALL
