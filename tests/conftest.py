import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from weftgraph.session import SESSION_DEFAULTS, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").appName("weftgraph-tests") \
        .config("spark.sql.shuffle.partitions", "8")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="weftgraph-test-")


def sf_dir(sf: str) -> str:
    return f"{TESTDATA}/sf{sf}"
