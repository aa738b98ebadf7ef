"""Feature tables from processed trips: hourly demand with history, and booking-time trips."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.operators.demand import add_history, describe_hours, hourly_counts
from rideflow.operators.enrich import flag_holidays, join_centroids
from rideflow.operators.features import booking_features
from rideflow.sinks.tables import TRIP_PARTITIONS, balance, write_partitioned

DEMAND_PARTITIONS = ("year", "month")
# Columns that hold no NULL; weather and borough may be unknown, and early hours have no history.
REQUIRED = {
    "demand": ("zone_id", "hour_ts", "trip_count", "date", "hour", "dayofweek", "is_weekend", "is_holiday"),
    "trips": ("pu_location_id", "do_location_id", "pickup_ts", "pickup_hour", "pickup_dayofweek", "is_holiday", "fare_amount", "trip_duration_min"),
}


@dataclass(frozen=True)
class FeatureTables:
    demand: DataFrame
    trips: DataFrame
    checks: DataFrame


def demand_feature_rows(trips: DataFrame, zones: DataFrame, hourly: DataFrame, holidays: DataFrame) -> DataFrame:
    """The demand table with lags and rolling means; history comes before the joins widen the rows."""
    return describe_hours(add_history(hourly_counts(trips)), zones, hourly, holidays)


def trip_feature_rows(trips: DataFrame, centroids: DataFrame, holidays: DataFrame) -> DataFrame:
    """Booking-time columns and the two targets of processed trips."""
    dated = join_centroids(trips, centroids).withColumn("pickup_date", F.to_date("pickup_ts"))
    return booking_features(flag_holidays(dated, holidays), "fare_amount", "trip_duration_min")


def build_features(
    trips: DataFrame, zones: DataFrame, hourly: DataFrame, holidays: DataFrame, centroids: DataFrame, out_path: str
) -> FeatureTables:
    """Write both tables by month and check them: rows, and NULLs in required columns."""
    spark = trips.sparkSession
    demand = demand_feature_rows(trips, zones, hourly, holidays)
    demand = demand.withColumns({"year": F.year("hour_ts"), "month": F.month("hour_ts")})
    write_partitioned(balance(demand, DEMAND_PARTITIONS), f"{out_path}/demand", DEMAND_PARTITIONS)
    booked = trip_feature_rows(trips, centroids, holidays)
    write_partitioned(balance(booked, TRIP_PARTITIONS), f"{out_path}/trips")
    written = {name: spark.read.parquet(f"{out_path}/{name}") for name in REQUIRED}
    checks = [_check(name, table) for name, table in written.items()]
    return FeatureTables(written["demand"], written["trips"], reduce(DataFrame.unionByName, checks))


def _check(name: str, table: DataFrame) -> DataFrame:
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in REQUIRED[name]))
    return table.agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("nulls")).select(
        F.lit(name).alias("table"), "rows", "nulls"
    )
