"""Explicit schemas of everything that is read, and of the canonical trip."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


TRIP = _struct(
    pickup_ts=T.TimestampType(),
    dropoff_ts=T.TimestampType(),
    pu_location_id=T.LongType(),
    do_location_id=T.LongType(),
    trip_distance_mi=T.DoubleType(),
    fare_amount=T.DoubleType(),
    tip_amount=T.DoubleType(),
    total_amount=T.DoubleType(),
    passenger_count=T.DoubleType(),
    service_type=T.StringType(),
)

ZONES = _struct(
    LocationID=T.IntegerType(),
    Borough=T.StringType(),
    Zone=T.StringType(),
    service_zone=T.StringType(),
)

CENTROIDS = _struct(LocationID=T.IntegerType(), lat=T.DoubleType(), lon=T.DoubleType())

WEATHER_DOCUMENT = _struct(
    hourly=_struct(
        time=T.ArrayType(T.StringType()),
        temperature_2m=T.ArrayType(T.DoubleType()),
        precipitation=T.ArrayType(T.DoubleType()),
        rain=T.ArrayType(T.DoubleType()),
        wind_speed_10m=T.ArrayType(T.DoubleType()),
        relative_humidity_2m=T.ArrayType(T.DoubleType()),
    )
)

TRIP_EVENT = _struct(
    VendorID=T.LongType(),
    tpep_pickup_datetime=T.StringType(),
    tpep_dropoff_datetime=T.StringType(),
    passenger_count=T.DoubleType(),
    trip_distance=T.DoubleType(),
    PULocationID=T.LongType(),
    DOLocationID=T.LongType(),
    fare_amount=T.DoubleType(),
)

SKIPPED_MONTH = _struct(
    service=T.StringType(), year=T.IntegerType(), month=T.IntegerType(), reason=T.StringType()
)
