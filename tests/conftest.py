import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dockflow.session import build_session
    ckpt = tempfile.mkdtemp(prefix="dockflow-test-ckpt-")
    s = build_session("local[4]", 4, app_name="dockflow-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
