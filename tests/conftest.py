import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_SMOKE = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerwright.session import build_session, checkpoint_root
    s = build_session(master="local[4]", shuffle_partitions=4, app="ledgerwright-tests")
    checkpoint_root(s)
    yield s
    s.stop()
