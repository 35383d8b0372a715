import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from starwright.session import build_session, checkpoint_dir

    s = build_session("tests", cpus=4, shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g",
                             "spark.local.dir": tempfile.mkdtemp(prefix="sw-local-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sw-test-")
