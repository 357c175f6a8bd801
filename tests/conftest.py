from __future__ import annotations

import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pedalflow.schemas import EVENTS, STATIONS, TRIPS, USERS, Mobility  # noqa: E402
from pedalflow.session import get_spark  # noqa: E402
from helpers import at  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("pedalflow-tests", "local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="session")
def city(spark) -> Mobility:
    """Hand-made rows: a user and a station without trips, references that are null or lead nowhere, a loop."""
    born = datetime.date(1990, 1, 2)
    users = [(1, "Ann", "A", born, "Italy"), (2, "Ben", "B", born, "Spain"), (3, "Cy", "C", born, "India")]
    stations = [(10, "North", "Rome", 12), (20, "South", "Rome", 30), (30, "East", "Bari", 40), (40, "Far", "Turin", 20)]
    trips = [
        (100, 1, 10, 20, at(1), at(1, 30), 3.5),
        (101, 1, 20, 10, at(2), at(2, 10), 2.0),
        (102, 2, 10, 10, at(3), at(3), 1.0),
        (103, None, 20, 30, at(4), at(4, 20), 4.0),
        (104, 9, 30, 20, at(5), at(5, 5), 1.5),
        (105, 2, 99, 30, at(6), at(6, 1), 1.1),
        (106, 2, None, 20, at(7), at(7, 1), 1.2),
    ]
    events = [
        (1, 100, at(1, 20), "ERROR", "Sensor failure"),
        (2, 100, at(1, 10), "BATTERY", "85%"),
        (3, 100, at(1, 15), "ERROR", "Brake fault detected"),
        (4, 101, at(2, 5), "GPS", "45.0,9.1"),
        (5, 104, at(5, 1), "ERROR", "Network timeout"),
        (6, 103, at(4, 5), "BATTERY", "20%"),
        (7, None, at(8), "DELAY", "Road works"),
        (8, 555, at(8), "DELAY", "Road works"),
    ]
    make = spark.createDataFrame
    return Mobility(make(users, USERS), make(stations, STATIONS), make(trips, TRIPS), make(events, EVENTS))
