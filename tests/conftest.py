import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pitchforge.session import get_session
    ckpt = tempfile.mkdtemp(prefix="pitchforge-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()
