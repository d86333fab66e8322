import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from kerbline.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("kerbline-tests", cpus=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA
