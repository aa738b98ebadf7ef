"""Hand-made canonical trips."""

from __future__ import annotations

import datetime as dt

from rideflow import schemas

START = dt.datetime(2024, 1, 10, 8, 0, 0)


def trip(**changes) -> dict:
    """A trip that passes every rule, with changes; ``seconds`` sets the duration."""
    row = {
        "pickup_ts": START,
        "dropoff_ts": None,
        "pu_location_id": 10,
        "do_location_id": 20,
        "trip_distance_mi": 3.0,
        "fare_amount": 12.0,
        "tip_amount": 2.0,
        "total_amount": 14.0,
        "passenger_count": 1.0,
        "service_type": "yellow",
    }
    seconds = changes.pop("seconds", 600)
    row |= changes
    if "dropoff_ts" not in changes and row["pickup_ts"] is not None:
        row["dropoff_ts"] = row["pickup_ts"] + dt.timedelta(seconds=seconds)
    return row


def frame(spark, rows: list[dict]):
    names = schemas.TRIP.fieldNames()
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schemas.TRIP)
