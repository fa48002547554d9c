"""One session for all tests; its folders are made anew for each run."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("SPARK_TEST_DIR", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


@pytest.fixture(scope="session")
def spark():
    from loremill.operators.components import clear
    from tests.oracle import session

    s = session("tests", "4")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    clear(s)
    s.stop()
