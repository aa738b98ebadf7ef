"""Trip events as JSON: sources, parsing, encoding, replay times and the Kafka sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow import schemas

def kafka_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    most_per_batch: int | None = None,
    fail_on_loss: bool = True,
) -> DataFrame:
    """Events of one topic; needs Spark's Kafka connector on the class path.

    ``most_per_batch`` bounds the events of a micro-batch, the first one from the earliest offset included.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_loss).lower())
    )
    if most_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", most_per_batch)
    return reader.load()


def file_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Events from text files, one JSON document per line, in the ``value`` column."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def parse_events(values: DataFrame) -> DataFrame:
    """Fields of each event and its two times; what cannot be parsed is NULL.

    The one-element array keeps later filters from copying the JSON parser below themselves, which
    would parse each event twice.
    """
    event = F.from_json(F.col("value").cast("string"), schemas.TRIP_EVENT)
    return (
        values.select(F.inline_outer(F.array(event)))
        .withColumns({
            "pickup_time": F.try_to_timestamp("tpep_pickup_datetime"),
            "dropoff_time": F.try_to_timestamp("tpep_dropoff_datetime"),
        })
    )


def _time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def encode_trips(trips: DataFrame, vendor: int = 1) -> DataFrame:
    """Canonical trips as events: ``key`` is the pickup zone, ``value`` the JSON text."""
    fields = F.struct(
        F.lit(vendor).cast("bigint").alias("VendorID"),
        _time_text("pickup_ts").alias("tpep_pickup_datetime"),
        _time_text("dropoff_ts").alias("tpep_dropoff_datetime"),
        F.col("passenger_count"),
        F.col("trip_distance_mi").alias("trip_distance"),
        F.col("pu_location_id").alias("PULocationID"),
        F.col("do_location_id").alias("DOLocationID"),
        F.col("fare_amount"),
    )
    return trips.select(F.col("pu_location_id").cast("string").alias("key"), F.to_json(fields).alias("value"))


def write_to_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Send encoded events; a zone's events share a key and so keep to one partition."""
    events.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def write_to_text(events: DataFrame, folder: str, mode: str = "append") -> None:
    events.select("value").write.mode(mode).text(folder)


def replay_schedule(trips: DataFrame, start: str, speedup: float = 60.0) -> DataFrame:
    """When each trip is due in a replay that runs ``speedup`` times faster than the clock.

    The earliest pickup is due at ``start``. Rows are range-partitioned and sorted by time; trips
    of one instant are spread by a second key, so they need not share a task.
    """
    spread = F.xxhash64(*trips.columns) + F.spark_partition_id()
    first = trips.agg(F.min("pickup_ts")).scalar()
    elapsed = F.unix_micros("pickup_ts") - F.unix_micros(first)
    due = F.unix_micros(F.lit(start).cast("timestamp")) + F.floor(elapsed / F.lit(float(speedup)))
    timed = trips.filter(F.col("pickup_ts").isNotNull()).withColumns({"event_ts": F.timestamp_micros(due), "_spread": spread})
    return timed.orderBy("pickup_ts", "_spread").drop("_spread")
