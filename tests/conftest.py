import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session

    session = build_session(
        "tests", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def scratch(spark):
    from riskloom.session import scratch_dir

    return lambda label: scratch_dir(spark, label)
