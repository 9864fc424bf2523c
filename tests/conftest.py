"""One local session for all tests, and small builders for hand-written rows."""

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fareloom.schemas import RAW, SILVER, WEATHER, ZONES  # noqa: E402
from fareloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "fareloom-tests",
        {
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """Text path of a new folder; ``folder("x")`` is a path inside it."""
    return lambda *parts: str(tmp_path.joinpath(*parts))


def at(text):
    return datetime.fromisoformat(text) if text else None


def frame(spark, schema, rows):
    """A frame of ``schema`` from dicts; missing columns are null."""
    return spark.createDataFrame([tuple(row.get(name) for name in schema.fieldNames()) for row in rows], schema)


def raw_trips(spark, rows):
    return frame(spark, RAW, rows)


def silver_trips(spark, rows):
    return frame(spark, SILVER, rows)


def zone_table(spark, rows):
    return frame(spark, ZONES, [dict(zip(("LocationID", "Zone"), row)) for row in rows])


def weather_rows(spark, rows):
    return frame(spark, WEATHER, [dict(zip(("name", "datetime", "tempmax", "tempmin"), row)) for row in rows])


def rows_of(df):
    """The rows as a sorted list of tuples, for comparing as multisets."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
