import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from skeinmart.session import local_session

    scratch = tempfile.mkdtemp(prefix="skeinmart-tests-")
    session = local_session(
        "*",
        "tests",
        shuffle_partitions="4",
        **{"spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.checkpoint.dir": f"{scratch}/shared"},
    )
    yield session
    session.stop()
