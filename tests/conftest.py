import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from trailmart.session import get_spark

    session = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no test data")
    return str(folder)
