import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from visitflow.session import local_session
    s = local_session(4, shuffle_partitions=8, app="visitflow-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="visitflow-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="visitflow-test-")
