import os

import pytest

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DIR):
        pytest.skip("the test tables are missing")
    return DIR
