import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from snapfold.session import local_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        4,
        shuffle_partitions=4,
        memory="4g",
        extra={"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture
def lake(spark, tmp_path, request):
    from snapfold.sources.lake import Lake

    prefix = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)[:60] + "_"
    return Lake(spark, str(tmp_path / "lake"), prefix=prefix)
