from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="sluice-tests")
    yield s


@pytest.fixture()
def tmp(spark):
    """A fresh folder for one test (never reused)."""
    return tempfile.mkdtemp(prefix="sluice-test-")
