import pytest

from ledgerlens.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false", "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
