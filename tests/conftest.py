import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weftline.session import local_session

    session = local_session(cpus=8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
