import datetime as dt
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

os.environ.setdefault("TZ", "UTC")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from anchorframe import build_session

    session = build_session("local[8]", 4, **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


A = at("2024-01-10T12:00:00")


def plus(hours: float = 0, us: int = 0, days: float = 0) -> dt.datetime:
    return A + dt.timedelta(hours=hours, microseconds=us, days=days)


@pytest.fixture()
def points(spark):
    """points(rows): rows of (entity, ts, label, value)."""
    return lambda rows: spark.createDataFrame(rows, "entity long, ts timestamp, label string, value double")


@pytest.fixture()
def anchors(spark):
    return lambda rows=((1, A),): spark.createDataFrame(list(rows), "entity long, anchor_ts timestamp")


@pytest.fixture()
def intervals(spark):
    return lambda rows: spark.createDataFrame(rows, "entity long, start_ts timestamp, end_ts timestamp, label string, amount double")


@pytest.fixture()
def cohort(spark):
    return lambda ids: spark.createDataFrame([(i,) for i in ids], "entity long")


def as_dict(df, key="entity"):
    return {r[key]: r.asDict() for r in df.collect()}
