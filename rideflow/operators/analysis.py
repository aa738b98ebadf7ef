"""Reports over processed trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideflow.functions.columns import hour_start
from rideflow.operators.enrich import join_weather


def trips_by_borough(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("pu_borough").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("fare_amount").alias("avg_fare")
    )


def trips_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.hour("pickup_ts").alias("pickup_hour")).agg(F.count(F.lit(1)).alias("trips"))


def fare_by_service(trips: DataFrame) -> DataFrame:
    return trips.groupBy("service_type").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("fare_amount").alias("avg_fare")
    )


def zone_hour_trips(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone and hour of the day."""
    return trips.groupBy("pu_location_id", F.hour("pickup_ts").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("trips")
    )


def top_k(rows: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The ``k`` rows of highest ``by``; ties go to the smaller ``tie``."""
    return rows.orderBy(F.desc(by), tie).limit(k)


def top_pickup_zones(trips: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` busiest pickup zones."""
    counts = trips.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("trips"))
    return top_k(counts, "trips", "pu_location_id", k)


def rank_zones(counts: DataFrame, by: str, within: str, k: int) -> DataFrame:
    """The ``k`` first zones by ``by`` in each group of ``within``."""
    order = Window.partitionBy(within).orderBy(F.desc(by), "zone_id")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rain_effect(trips: DataFrame, hourly: DataFrame) -> DataFrame:
    """Mean trips per hour in dry, rainy and unknown hours; trips are counted before the join."""
    per_hour = trips.groupBy(hour_start("pickup_ts").alias("hour_ts")).agg(F.count(F.lit(1)).alias("trips"))
    return (
        join_weather(per_hour, hourly, ts="hour_ts")
        .groupBy("is_rainy")
        .agg(F.count(F.lit(1)).alias("hours"), F.sum("trips").alias("trips"), F.avg("trips").alias("avg_trips"))
    )
