import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from relmod.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=4, app="relmod-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run(spark):
    from relmod.session import scratch_dir

    d = scratch_dir(spark, "test")
    # the checkpoint folder is a URI; tests write their inputs with plain Python I/O
    d = d[len("file:"):] if d.startswith("file:") else d
    os.makedirs(d, exist_ok=True)
    return d
