import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from mallscope.session import get_session
    import tempfile
    s = get_session("local[*]", app="mallscope-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mallscope-wh-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
