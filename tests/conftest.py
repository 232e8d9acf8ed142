import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from railyard.session import BASE_CONF, prepare_session

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("railyard-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    prepare_session(session)
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="railyard-test-")
