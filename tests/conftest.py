import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickflow.session import local_session
    scratch = tempfile.mkdtemp(prefix="tickflow-test-")
    s = local_session(cores=4, shuffle_partitions=4, extra={"spark.checkpoint.dir": scratch})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from tickflow.session import scratch_path
    return scratch_path(spark, "test")
