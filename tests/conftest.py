import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from vacancia.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("vacancia-tests", master="local[8]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.log.level": "ERROR",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="vacancia-warehouse-"),
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
