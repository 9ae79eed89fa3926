import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="tidemark-tests",
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)
