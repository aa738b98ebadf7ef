"""Zone, weather, holiday and centroid joins of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.columns import flag, haversine_mi, hour_start
from rideflow.operators.lookup import lookup_join

RAINY_MM = 0.1

# Document field and canonical name of each hourly reading.
_READINGS = {
    "temperature_2m": "temperature_c",
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "wind_speed_10m": "wind_speed_kmh",
    "relative_humidity_2m": "humidity_pct",
}
WEATHER_COLUMNS = ("weather_ts", *_READINGS.values(), "is_rainy")


def _zone_names(zones: DataFrame, side: str) -> DataFrame:
    return zones.select(
        F.col("LocationID").try_cast("bigint").alias("zone_id"),
        F.col("Borough").alias(f"{side}_borough"),
        F.col("Zone").alias(f"{side}_zone"),
        F.col("service_zone").alias(f"{side}_service_zone"),
    )


def join_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough, zone name and service zone of pickup (``pu_``) and dropoff (``do_``)."""
    for side in ("pu", "do"):
        trips = lookup_join(trips, _zone_names(zones, side), {f"{side}_location_id": "zone_id"})
    return trips


def join_pickup_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The pickup side only."""
    return lookup_join(trips, _zone_names(zones, "pu"), {"pu_location_id": "zone_id"})


def hourly_weather(documents: DataFrame) -> DataFrame:
    """One row per hour from documents of parallel arrays; short arrays are padded with NULL."""
    readings = F.arrays_zip(F.col("hourly.time"), *(F.col(f"hourly.{name}") for name in _READINGS))
    return (
        documents.select(F.explode(readings).alias("reading"))
        .select(
            F.col("reading.time").try_cast("timestamp").alias("weather_ts"),
            *(F.col(f"reading.{source}").try_cast("double").alias(name) for source, name in _READINGS.items()),
        )
        .withColumn("is_rainy", flag(F.col("rain_mm") > RAINY_MM))
    )


def repeated_hours(hourly: DataFrame) -> DataFrame:
    """Hours that occur more than once; each would multiply its trips."""
    known = hourly.filter(F.col("weather_ts").isNotNull())
    return known.groupBy(hour_start("weather_ts").alias("weather_hour")).count().filter("count > 1")


def join_weather(rows: DataFrame, hourly: DataFrame, ts: str = "pickup_ts", check_hours: bool = True) -> DataFrame:
    """Weather of the hour of ``ts``; rows without a reading keep NULL.

    A repeated hour raises, unless ``check_hours`` is off: then each reading gives a row.
    """
    if check_hours and not repeated_hours(hourly).isEmpty():
        raise ValueError("the weather data holds an hour more than once")
    keyed = hourly.withColumn("weather_hour", hour_start("weather_ts"))
    trips = rows.withColumn("_hour", hour_start(ts))
    return lookup_join(trips, keyed, {"_hour": "weather_hour"}).drop("_hour")


def weather_match_rate(enriched: DataFrame) -> DataFrame:
    """Trips without weather, and their share."""
    missing = F.count_if(F.col("weather_ts").isNull())
    trips = F.count(F.lit(1))
    return enriched.agg(
        trips.alias("trips"),
        missing.alias("unmatched"),
        F.try_divide(missing * 100.0, trips).alias("unmatched_pct"),
    )


def flag_holidays(rows: DataFrame, holidays: DataFrame, date: str = "pickup_date") -> DataFrame:
    """``is_holiday`` from a table with one ``holiday`` date column."""
    days = holidays.select("holiday").distinct().withColumn("_found", F.lit(1))
    joined = lookup_join(rows, days, {date: "holiday"})
    return joined.withColumn("is_holiday", F.coalesce("_found", F.lit(0))).drop("_found")


def join_centroids(trips: DataFrame, centroids: DataFrame) -> DataFrame:
    """Great-circle miles between the centroids of the two zones, as known at booking time."""
    for side in ("pu", "do"):
        points = centroids.select(
            F.col("LocationID").try_cast("bigint").alias("zone_id"),
            F.col("lat").alias(f"_{side}_lat"),
            F.col("lon").alias(f"_{side}_lon"),
        )
        trips = lookup_join(trips, points, {f"{side}_location_id": "zone_id"})
    ends = ("_pu_lat", "_pu_lon", "_do_lat", "_do_lon")
    return trips.withColumn("centroid_distance_mi", haversine_mi(*(F.col(c) for c in ends))).drop(*ends)
