import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza import schemas  # noqa: E402
from cadenza.operators.shaping import conform  # noqa: E402
from cadenza.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        4,
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def table(spark):
    """A raw table of dicts: unnamed columns are null, types follow the schema."""

    def make(name, rows):
        fields = {f.name: f for f in schemas.TABLES[name].fields}
        used = [n for n in fields if any(n in r for r in rows)]
        from pyspark.sql import types as T

        small = T.StructType([fields[n] for n in used])
        data = [tuple(_typed(fields[n].dataType, r.get(n)) for n in used) for r in rows]
        return conform(spark.createDataFrame(data, small), schemas.TABLES[name])

    return make


def _typed(kind, value):
    if value is None:
        return None
    name = kind.simpleString()
    if name == "double":
        return float(value)
    if name == "timestamp_ntz" and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    if name == "date" and isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value


@pytest.fixture(scope="session")
def run_row():
    """A valid run; keyword arguments change it."""

    def make(**change):
        row = {
            "athlete_id": 1,
            "activity_id": "a",
            "activity_name": "Morning Run",
            "activity_date": "2025-03-05 07:30:00",
            "start_time_local": "2025-03-05 07:30:00",
            "activity_type": "running",
            "distance_km": 10.0,
            "duration_minutes": 50.0,
            "duration_seconds": 3000.0,
            "avg_pace_min_km": 5.0,
            "avg_heart_rate": 140,
        }
        return {**row, **change}

    return make
