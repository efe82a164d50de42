import os
import sys
import tempfile
from datetime import datetime

import pytest

# short runs: cheap compilation matters more than fast code
os.environ.setdefault(
    "PYSPARK_SUBMIT_ARGS",
    '--conf "spark.driver.extraJavaOptions=-XX:TieredStopAtLevel=1 -XX:+UseParallelGC" pyspark-shell',
)
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("clickloom-tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="clickloom-test-")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


RAW_DDL = (
    "client_id string, page_url string, referrer string, timestamp string, event_name string, "
    "event_data string, user_agent string"
)


def raw_row(**changes):
    row = {
        "client_id": "c1",
        "page_url": "https://x/p",
        "referrer": None,
        "timestamp": "2024-01-01T10:00:00Z",
        "event_name": "page_viewed",
        "event_data": "{}",
        "user_agent": "agent",
    }
    row.update(changes)
    return tuple(row.values())


STG_DDL = (
    "client_id string, timestamp timestamp_ntz, event_name string, page_url string, referrer string, "
    "user_agent string, user_email string, transaction_id string, revenue double, items_json string, "
    "utm_source string, utm_medium string, utm_campaign string, channel_group string, platform string, "
    "os string, browser string"
)


def stg_row(client, time, event="page_viewed", email=None, txn=None, revenue=None, items=None,
            channel="Direct"):
    return (client, at(time), event, "https://x", None, "a", email, txn, revenue, items,
            "", "", "", channel, "Desktop", "Linux", "Chrome")
