import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from layerwright import session
    s = session.build("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                                     "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("OFF")
    return s
