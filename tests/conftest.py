import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cohortlens.session import get_session

    s = get_session("local[4]", 4, app="cohortlens-tests",
                    extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF001):
        pytest.skip("driver test data not present")
    return SF001
