from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rankforge.session import local_session

    s = local_session(4, shuffle_partitions=4, app="rankforge-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
