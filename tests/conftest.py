import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hamper.session import local_session

    # tests run locally, where no cluster names a checkpoint folder: supply our own
    ckpt = tempfile.mkdtemp(prefix="hamper-test-ckpt-")
    s = local_session(4, app="hamper-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="hamper-test-")
