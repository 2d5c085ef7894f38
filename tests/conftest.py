import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cyclemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cyclemill-tests-", dir="/tmp"))
    return session


@pytest.fixture
def engines(spark):
    """Two engines with 4 and 3 cycles; ``a`` repeats the cycle, ``b`` is constant."""
    rows = [(1, c, float(c), 0.1) for c in range(1, 5)] + [(2, c, float(c), 0.1) for c in range(1, 4)]
    return spark.createDataFrame(rows, "id long, cycle long, a double, b double")
