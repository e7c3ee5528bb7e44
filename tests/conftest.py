"""One small session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from readloom.plans.session import session

    s = session(
        f"local[{os.environ.get('BENCH_CPUS', '8')}]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
