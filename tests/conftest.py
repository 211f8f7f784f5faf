import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pricelake.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="pricelake-test-ckpt-")
    s = get_spark("local[4]", 8, app_name="pricelake-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="pricelake-test-")
