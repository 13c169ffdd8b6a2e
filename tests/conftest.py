import warnings

import pytest

from wayloom.session import local_session

warnings.filterwarnings("ignore", category=FutureWarning)


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, 8)
    yield s
    s.stop()
