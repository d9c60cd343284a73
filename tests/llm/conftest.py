import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(SF):
        pytest.skip("test tables not present")
    return SF
