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
    from quillspark.session import build_session
    scratch = tempfile.mkdtemp(prefix="quill-tests-")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))   # tests set their own: unset otherwise
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="quill-run-")
