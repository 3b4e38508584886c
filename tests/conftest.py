import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shopgauge.session import get_session
    s = get_session("local[*]", app_name="shopgauge-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="sg-shared-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sg-warehouse-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
