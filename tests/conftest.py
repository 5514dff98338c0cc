import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    from tessera.session import scratch_dir
    return scratch_dir(spark, "test")
