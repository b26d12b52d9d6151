import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from covisit.session import session_builder  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = session_builder("tests", "local[8]", {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(home / "warehouse"),
        "spark.checkpoint.dir": str(home / "shared"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={home}",
    }).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def ansi_stays_on(spark):
    yield
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.fixture
def sf():
    return SF
