import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers inherit the environment: let them import test helpers.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests")] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

from ember.session import local_test_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_test_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
