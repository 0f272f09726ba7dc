import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from skyledger.session import ensure_checkpoint_dir

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = (
        SparkSession.builder.master(os.environ.get("SKYLEDGER_TEST_MASTER", "local[*]"))
        .appName("skyledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", warehouse)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # The session's spark.checkpoint.dir is used as given; only a session
    # without one gets a private temporary folder.
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
