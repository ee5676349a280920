import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from fareflow import session

    builder = (session.builder("tests", "local[8]").config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false"))
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fareflow-tests-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
