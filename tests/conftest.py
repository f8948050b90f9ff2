import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from opinlake.session import local_session

    s = local_session("4", "4g", 4)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    p = Path("/root/testdata/sf0.001")
    if not p.exists():
        pytest.skip("no test data here")
    return str(p)
