"""Demand per zone in event-time windows. Each function takes a stream or a batch frame."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.operators.lookup import lookup_join


def _watermarked(events: DataFrame, ts: str, delay: str) -> DataFrame:
    return events.withWatermark(ts, delay) if events.isStreaming else events


def windowed_demand(
    events: DataFrame,
    length: str,
    slide: str | None = None,
    watermark: str = "10 minutes",
    ts: str = "pickup_time",
    zone: str = "PULocationID",
) -> DataFrame:
    """``window, zone, trip_count, avg_fare``; counts combine before the shuffle, so a busy zone is small there."""
    period = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        _watermarked(events, ts, watermark)
        .groupBy(period, zone)
        .agg(F.count(F.lit(1)).alias("trip_count"), F.avg("fare_amount").alias("avg_fare"))
    )


def sliding_demand(events: DataFrame) -> DataFrame:
    """Five minutes, every minute, late by up to ten."""
    return windowed_demand(events, "5 minutes", "1 minute", "10 minutes")


def tumbling_demand(events: DataFrame) -> DataFrame:
    """Ten minutes, late by up to fifteen."""
    return windowed_demand(events, "10 minutes", watermark="15 minutes")


def trips_per_minute(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Live trips of all zones."""
    minute = F.window("pickup_time", "1 minute")
    return _watermarked(events, "pickup_time", watermark).groupBy(minute).agg(F.count(F.lit(1)).alias("trip_count"))


def flat_windows(demand: DataFrame) -> DataFrame:
    """``window_start`` and ``window_end`` instead of the window struct."""
    others = [c for c in demand.columns if c != "window"]
    return demand.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def sliding_demand_by_panes(events: DataFrame) -> DataFrame:
    """The sliding demand of a batch, built from one-minute counts.

    Events are counted once per minute and zone; the five windows of a minute then copy that
    one row and not each event.
    """
    panes = (
        events.groupBy(F.window("pickup_time", "1 minute").alias("pane"), "PULocationID")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("fare_amount").alias("fares"),
            F.count("fare_amount").alias("fared"),
        )
    )
    return (
        panes.withColumn("pane_start", F.col("pane.start"))
        .groupBy(F.window("pane_start", "5 minutes", "1 minute"), "PULocationID")
        .agg(
            F.sum("trips").alias("trip_count"),
            F.try_divide(F.sum("fares"), F.sum("fared")).alias("avg_fare"),
        )
    )


def name_zones(demand: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Borough and zone names beside the zone id; NULL where unknown or without a zone table."""
    flat = flat_windows(demand)
    if zones is None:
        nothing = F.lit(None).cast("string")
        named = flat.withColumns({"Borough": nothing, "Zone": nothing})
    else:
        names = zones.select(F.col("LocationID").try_cast("bigint").alias("id"), "Borough", "Zone")
        named = lookup_join(flat, names, {"PULocationID": "id"}, salts=1)
    return named.select("window_start", "window_end", "PULocationID", "Borough", "Zone", "trip_count", "avg_fare")


def join_forecast(demand: DataFrame, forecast: DataFrame, start: Column | None = None) -> DataFrame:
    """Forecast trips of the window's zone, hour and day of week, and observed over forecast.

    ``forecast`` holds ``zone_id, hour, dayofweek, forecast``; the window struct is kept.
    """
    start = F.col("window.start") if start is None else start
    keyed = demand.withColumns({"_hour": F.hour(start), "_day": F.dayofweek(start)})
    keys = {"PULocationID": "zone_id", "_hour": "hour", "_day": "dayofweek"}
    joined = lookup_join(keyed, forecast, keys, salts=1).drop("_hour", "_day")
    return joined.withColumn("surge_ratio", F.try_divide(F.col("trip_count").cast("double"), F.col("forecast")))


def score_windows(demand: DataFrame, inputs: DataFrame, model: Model) -> DataFrame:
    """Predicted beside observed trips of each hourly window; NULL where a window has no inputs.

    ``inputs`` holds the model inputs of the zones' hours, known before the hour starts. They are
    scored first; the windows join the finished forecasts.
    """
    flat = flat_windows(demand)
    forecasts = model.transform(inputs.drop("trip_count")).select("zone_id", "hour_ts", F.col("prediction").alias("forecast"))
    return lookup_join(flat, forecasts, {"PULocationID": "zone_id", "window_start": "hour_ts"}, salts=1)
