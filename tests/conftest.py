import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakeshard.session import get_session

    s = get_session("local[4]", 4, app_name="lakeshard-tests",
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ls-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ls-test-")
