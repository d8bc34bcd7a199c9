import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sylvan import get_session

    s = get_session(
        app="sylvan-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sylvan-wh-")},
    )
    yield s
    s.stop()
