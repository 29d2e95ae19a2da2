import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    os.environ.setdefault("STRATA_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    s = get_session("local[4]", app="strata-tests", **{"spark.sql.shuffle.partitions": "4",
                                                       "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


SF_SMOKE = "/root/testdata/sf0.001"
