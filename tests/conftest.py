import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    work = tempfile.mkdtemp(prefix="strata-test-")
    s = get_session(master="local[4]", app_name="strata-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": os.path.join(work, "warehouse"),
                           "spark.checkpoint.dir": os.path.join(work, "checkpoints")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
