from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripscope.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # A test run is a local session: it gets its own fresh shared folder.
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session(
        "tripscope-tests",
        master="local[4]",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": shared},
    )
    yield s
    s.stop()


TRIP_DDL = (
    "l_orderkey bigint, pickup_ts timestamp, dropoff_ts timestamp, trip_distance double, "
    "pu_location_id int, do_location_id int, payment_type int, fare_amount decimal(12,2), "
    "tip_amount decimal(16,4), total_amount decimal(16,4), passenger_count int, "
    "duration_minutes double, pickup_hour int, pickup_day int, vendor_id int"
)


def trip(
    key: int,
    start: dt.datetime,
    seconds: int = 600,
    distance: float = 2.0,
    pu: int | None = 1,
    do: int | None = 2,
    payment: int = 1,
    fare: str = "10.00",
    tip: str = "1.0000",
    total: str | None = None,
    passengers: int | None = 1,
    vendor: int = 1,
):
    """One row of TRIP_DDL with the derived columns filled consistently."""
    from decimal import Decimal

    end = start + dt.timedelta(seconds=seconds)
    tot = Decimal(total) if total is not None else Decimal(fare) + Decimal(tip)
    return (
        key, start, end, distance, pu, do, payment, Decimal(fare), Decimal(tip), tot, passengers,
        seconds / 60.0, start.hour, start.day, vendor,
    )


@pytest.fixture()
def make_trips(spark):
    def make(rows):
        return spark.createDataFrame(rows, TRIP_DDL)

    return make


@pytest.fixture()
def zones_small(spark):
    return spark.createDataFrame(
        [(1, "Manhattan", "Midtown"), (2, "Queens", "JFK Airport"), (3, "EWR", "Newark Airport"),
         (4, "Brooklyn", "Park Slope")],
        "LocationID int, Borough string, Zone string",
    )
