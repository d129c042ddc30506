import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from loomspan.session import build_session

    session = build_session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
