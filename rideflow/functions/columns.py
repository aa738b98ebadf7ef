"""Column expressions over canonical trips."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone ids of the three airports.
AIRPORT_ZONES = (1, 132, 138)
EARTH_RADIUS_MI = 3958.7613


def find_column(df: DataFrame, *names: str) -> Column:
    """The first column, in the frame's own order, whose name matches ignoring case; NULL if none does."""
    wanted = {name.lower() for name in names}
    for column in df.columns:
        if column.lower() in wanted:
            return df[f"`{column}`"]
    return F.lit(None)


def trip_seconds() -> Column:
    """Whole seconds from pickup to dropoff."""
    return F.unix_timestamp("dropoff_ts") - F.unix_timestamp("pickup_ts")


def speed_mph() -> Column:
    return F.try_divide(F.col("trip_distance_mi"), trip_seconds() / F.lit(3600.0))


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def hour_start(ts: str | Column) -> Column:
    return F.date_trunc("hour", ts)


def epoch_hour(ts: str | Column) -> Column:
    """Hours since 1970 as a bigint; range frames run over it."""
    return F.floor(F.unix_timestamp(ts) / 3600)


def touches_airport(pickup: str = "pu_location_id", dropoff: str = "do_location_id") -> Column:
    return F.col(pickup).isin(*AIRPORT_ZONES) | F.col(dropoff).isin(*AIRPORT_ZONES)


def haversine_mi(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles between two points in degrees."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def hour_angle(hour: str) -> Column:
    """Position of an hour on the 24-hour circle, in radians."""
    return F.lit(2 * math.pi) * F.col(hour) / F.lit(24.0)
