"""Bring the three trip feeds into the canonical schema."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.functions.columns import find_column

# Source column of each canonical column, per feed.
_METERED = {
    "pu_location_id": "PULocationID",
    "do_location_id": "DOLocationID",
    "trip_distance_mi": "trip_distance",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
    "passenger_count": "passenger_count",
}
FEEDS = {
    "yellow": {"pickup_ts": "tpep_pickup_datetime", "dropoff_ts": "tpep_dropoff_datetime", **_METERED},
    "green": {"pickup_ts": "lpep_pickup_datetime", "dropoff_ts": "lpep_dropoff_datetime", **_METERED},
    "fhvhv": {
        "pickup_ts": "pickup_datetime",
        "dropoff_ts": "dropoff_datetime",
        "pu_location_id": "PULocationID",
        "do_location_id": "DOLocationID",
        "trip_distance_mi": "trip_miles",
        "fare_amount": "base_passenger_fare",
        "tip_amount": "tips",
    },
}
# Parts of the for-hire total, in the order they are added.
FHVHV_TOTAL_PARTS = ("base_passenger_fare", "tolls", "sales_tax", "congestion_surcharge", "tips")


def _fhvhv_total(feed: DataFrame, absent_as_zero: bool) -> Column:
    present = {column.lower() for column in feed.columns}
    parts = []
    for part in FHVHV_TOTAL_PARTS:
        if absent_as_zero and part not in present:
            parts.append(F.lit(0.0))
        else:
            parts.append(find_column(feed, part).try_cast("double"))
    return reduce(lambda total, part: total + part, parts)


def unify(feed: DataFrame, service: str, absent_as_zero: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """Project one feed to the canonical trip; absent columns and failing casts become NULL.

    ``absent_as_zero`` counts a missing part of the for-hire total as 0 instead of NULL.
    ``keep`` names extra columns to carry along, such as the month of the file.
    """
    service = service.lower()
    if service not in FEEDS:
        raise ValueError(f"unknown service type: {service}")
    mapping = FEEDS[service]
    columns = []
    for field in schemas.TRIP.fields:
        if field.name == "service_type":
            value = F.lit(service)
        elif field.name == "total_amount" and service == "fhvhv":
            value = _fhvhv_total(feed, absent_as_zero)
        elif field.name in mapping:
            value = find_column(feed, mapping[field.name])
        else:
            value = F.lit(None)
        if field.name != "service_type":
            value = value.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return feed.select(*columns, *keep)


def no_trips(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.TRIP)


def union_trips(frames: Iterable[DataFrame], spark: SparkSession) -> DataFrame:
    """All frames by column name; an empty canonical frame if there are none."""
    frames = list(frames)
    if not frames:
        return no_trips(spark)
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
