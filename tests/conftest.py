import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([ROOT, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))


@pytest.fixture(scope="session")
def spark():
    from chirpscope.session import get_spark
    s = get_spark(master="local[4]", partitions=4)
    yield s
