import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from trellis.session import build_session, ship_package

    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
