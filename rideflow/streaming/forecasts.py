"""Forecasts as a versioned table: written once per model and range of hours, read by micro-batches for their own hours only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.operators.lookup import lookup_join

KEYS = {"PULocationID": "zone_id", "window_start": "hour_ts"}


def write_forecasts(forecasts: DataFrame, path: str, version: str) -> None:
    """``zone_id, hour_ts, forecast`` as a version, a folder per day; what the version holds of these days is replaced.

    A version counts from its first complete write on: readers see only days that are written out.
    """
    dated = forecasts.select("zone_id", "hour_ts", F.col("forecast").cast("double").alias("forecast")).withColumn("day", F.to_date("hour_ts"))
    writer = dated.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(f"{path}/version={version}")


def read_forecasts(spark: SparkSession, path: str, version: str, since=None, until=None) -> DataFrame:
    """The forecasts of a version from an hour on, up to another one; only the days between are read."""
    rows = spark.read.schema("zone_id bigint, hour_ts timestamp, forecast double, day date").parquet(f"{path}/version={version}")
    if since is not None:
        rows = rows.filter((F.col("day") >= F.to_date(F.lit(since))) & (F.col("hour_ts") >= F.lit(since)))
    if until is not None:
        rows = rows.filter((F.col("day") <= F.to_date(F.lit(until))) & (F.col("hour_ts") <= F.lit(until)))
    return rows.drop("day")


def forecast_lookup(path: str, version: str | Callable[[], str]) -> Callable[[DataFrame], DataFrame]:
    """What joins a micro-batch of hourly windows to the forecasts of its hours; ``forecast`` is null where there is none.

    The version is a name, or asked for in each batch.
    """

    def joined(rows: DataFrame) -> DataFrame:
        span = rows.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last")).first()
        name = version() if callable(version) else version
        known = read_forecasts(rows.sparkSession, path, name, span["first"], span["last"])
        return lookup_join(rows, known if span["first"] is not None else known.limit(0), KEYS, salts=1)

    return joined
