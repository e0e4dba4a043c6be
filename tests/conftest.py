import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.schemas import EVENT_SCHEMA, MART_SCHEMA  # noqa: E402
from eventmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(app_name="eventmart-tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def event(account="a", app="x", ts=1704067207179, event_id="1", kind="logout", purchase=0.0,
          payment="credit", session="s", lat=1.0, lon=2.0):
    return (account, app, ts, event_id, kind, purchase, payment, session, lat, lon)


@pytest.fixture(scope="session")
def make_events(spark):
    def make(*rows):
        return spark.createDataFrame([event(**r) for r in rows], EVENT_SCHEMA)
    return make


@pytest.fixture(scope="session")
def make_marts(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), MART_SCHEMA)
    return make


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
