import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from changeflow.session import get_session
    scratch = tempfile.mkdtemp(prefix="changeflow-test-")
    s = get_session("local[8]", app="changeflow-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.checkpoint.dir": scratch + "/ckpt"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
