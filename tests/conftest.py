import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paygrid.session import CHECKPOINT_CONF, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="paygrid-tests-")
    session = build_session("local[*]", app_name="paygrid-tests", shuffle_partitions=8,
                            extra={CHECKPOINT_CONF: scratch,
                                   "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield session
    session.stop()
