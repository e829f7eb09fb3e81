import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weftline.session import build_session

    return build_session("tests", cores=4)


@pytest.fixture(scope="session")
def data():
    return DATA
