import pytest

from promolens.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        "4",
        **{"spark.checkpoint.dir": str(root / "work"), "spark.sql.warehouse.dir": str(root / "warehouse")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
