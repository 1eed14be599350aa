import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from funnelspark.session import build_session
    s = build_session("local[4]", app_name="funnelspark-tests", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="fs-test-ckpt-"),
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fs-test-")
