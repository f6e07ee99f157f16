import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from viewtide.session import build_session

    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def logs_of(spark):
    """Log rows from dicts; fields left out are NULL."""
    from viewtide import schemas

    def make(*rows):
        full = [tuple(row.get(name) for name in schemas.LOG_FIELDS) for row in rows]
        return spark.createDataFrame(full, schemas.LOG)

    return make


@pytest.fixture
def messages_of(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make
