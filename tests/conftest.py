import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.plans.layout import Layout  # noqa: E402
from tidemark.session import build_session, new_run_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": 4,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": 100000,
        "spark.sql.debug.maxToStringFields": 1000,
    }
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def run_dir(spark):
    return new_run_dir(spark, "test")


@pytest.fixture
def layout(run_dir):
    return Layout(run_dir)
