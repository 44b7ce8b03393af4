import pytest

from casebook import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    found = session.build_session(
        "casebook-tests", "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
