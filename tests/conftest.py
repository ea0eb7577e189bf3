import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripwire.session import build_session
    # spark.checkpoint.dir comes from the deployment when set; otherwise the
    # session helper registers a fresh local folder (tests only).
    s = build_session(app_name="tripwire-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.sql.streaming.minBatchesToRetain": "5"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test."""
    return tempfile.mkdtemp(prefix="tripwire-run-")
