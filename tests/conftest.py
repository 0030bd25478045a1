import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trawl.session import get_spark

    s = get_spark("trawl-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="trawl-warehouse-")})
    yield s
    s.stop()
