import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sievemark.session import session, ship_package

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/sievemark-warehouse"}
    s = session("tests", "local[4]", **conf)
    s.sparkContext.setLogLevel("ERROR")
    return ship_package(s)
