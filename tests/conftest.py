import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
GOLDEN_DIR = os.environ.get("PAIRFORGE_GOLDEN_DIR", "")  # published merge list and vocabulary, if at hand


@pytest.fixture(scope="session")
def spark():
    from pairforge.session import local_session

    s = local_session("*", 8, "pairforge-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
