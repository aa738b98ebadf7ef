"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.columns import flag, hour_angle, speed_mph, touches_airport, trip_seconds

# What a rider's request already fixes; nothing measured during or after the trip.
BOOKING_COLUMNS = (
    "pu_location_id",
    "do_location_id",
    "centroid_distance_mi",
    "pickup_ts",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_year",
    "is_weekend",
    "is_night",
    "is_airport_trip",
    "is_holiday",
    "temperature_c",
    "precipitation_mm",
    "rain_mm",
    "wind_speed_kmh",
    "humidity_pct",
    "is_rainy",
    "passenger_count",
    "service_type",
    "pu_borough",
    "do_borough",
)


def add_trip_features(trips: DataFrame) -> DataFrame:
    """Duration, speed, calendar and rate columns of each trip."""
    day = F.dayofweek("pickup_ts")
    hour = F.hour("pickup_ts")
    return trips.withColumns({
        "trip_duration_min": F.round(trip_seconds() / F.lit(60.0), 2),
        "avg_speed_mph": F.round(speed_mph(), 2),
        "pickup_hour": hour,
        "pickup_dayofweek": day,
        "pickup_month": F.month("pickup_ts"),
        "pickup_year": F.year("pickup_ts"),
        "is_weekend": flag(day.isin(1, 7)),
        "is_night": flag((hour >= 22) | (hour < 5)),
        "is_airport_trip": flag(touches_airport()),
        "fare_per_mile": F.round(F.try_divide("fare_amount", "trip_distance_mi"), 2),
    })


def within_training_bounds(trips: DataFrame) -> DataFrame:
    """Trips whose distance, fare and duration are plausible regression targets."""
    distance, fare, minutes = F.col("trip_distance_mi"), F.col("fare_amount"), F.col("trip_duration_min")
    return trips.filter(
        (distance > 0.1) & (distance < 50.0) & fare.between(2.5, 150.0) & minutes.between(1.0, 120.0)
    )


def add_training_features(
    trips: DataFrame, reference_calendar: bool = False, distance: str = "trip_distance_mi"
) -> DataFrame:
    """Cyclic hour, log distance and the 0/1 model inputs.

    Day 1 is Sunday. ``reference_calendar`` reproduces a reading of day 6 and 7 as the weekend
    and of days 1 to 5 as workdays.
    """
    day, hour = F.col("pickup_dayofweek"), F.col("pickup_hour")
    if reference_calendar:
        weekend, workday = day.isin(6, 7), day < 6
    else:
        weekend, workday = day.isin(1, 7), day.between(2, 6)
    rush = workday & (hour.between(7, 9) | hour.between(16, 19))
    return trips.withColumns({
        "sin_hour": F.sin(hour_angle("pickup_hour")),
        "cos_hour": F.cos(hour_angle("pickup_hour")),
        "log_distance": F.log1p(distance),
        "is_weekend": flag(weekend).cast("double"),
        "is_rush_hour": flag(rush).cast("double"),
        "is_evening_night": flag((hour >= 20) | (hour <= 6)).cast("double"),
        "is_airport": flag(touches_airport()).cast("double"),
    })


def booking_features(trips: DataFrame, *targets: str) -> DataFrame:
    """The booking-time columns and the named targets, and nothing else."""
    return trips.select(*BOOKING_COLUMNS, *targets)


def null_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and NULL count of the required columns, as one row."""
    return table.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns),
    )
