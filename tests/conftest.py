import tempfile

import pytest

from tarn.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-")
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")

