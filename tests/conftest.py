import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from workload.compare import connect, local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SF)


@pytest.fixture
def lake(spark):
    import uuid

    from corpusgraph.sources.lake import Lake
    from corpusgraph.sources.scratch import scratch_dir

    database = f"test_{uuid.uuid4().hex[:12]}"
    return Lake(spark, database, scratch_dir(spark, database))
