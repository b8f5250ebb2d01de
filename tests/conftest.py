import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickerpulse.session import build_session
    s = build_session("local[4]", app="tickerpulse-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tp-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tp-test-")
