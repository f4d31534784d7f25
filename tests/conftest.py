import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from costlens.session import local_session

    s = local_session(cpus=4, partitions=4, app="costlens-tests")
    yield s


@pytest.fixture(scope="session")
def params():
    from costlens.sources.testdata import fixture_params

    return fixture_params()
