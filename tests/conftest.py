import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tremor.session import build_session

    # spark.checkpoint.dir comes from the session's own configuration when it
    # has one; tremor.session falls back to a scratch folder only when unset.
    s = build_session("local[4]", app="tremor-tests", conf={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tremor-test-")
