import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from addrweave.session import local_session  # noqa: E402

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="addrweave-tests")
    yield s
    s.stop()
