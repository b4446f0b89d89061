import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemill.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "8", shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(base / "shared"), "spark.sql.warehouse.dir": str(base / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
