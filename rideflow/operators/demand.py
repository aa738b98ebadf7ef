"""The hourly demand table, its history columns and zone profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.functions.columns import epoch_hour, flag, hour_start
from rideflow.operators.enrich import flag_holidays, join_weather
from rideflow.operators.lookup import lookup_join

LAGS = (1, 2, 24, 168)
SPANS = (3, 24, 168)
BLOCK_HOURS = 672


def hourly_counts(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone and hour: ``zone_id, hour_ts, trip_count``."""
    return trips.groupBy(F.col("pu_location_id").alias("zone_id"), hour_start("pickup_ts").alias("hour_ts")).agg(
        F.count(F.lit(1)).alias("trip_count")
    )


def add_calendar(demand: DataFrame) -> DataFrame:
    """Date, hour, day of week and weekend flag of ``hour_ts``."""
    return demand.withColumns({
        "date": F.to_date("hour_ts"),
        "hour": F.hour("hour_ts"),
        "dayofweek": F.dayofweek("hour_ts"),
        "is_weekend": flag(F.dayofweek("hour_ts").isin(1, 7)),
    })


def demand_table(trips: DataFrame, zones: DataFrame, hourly: DataFrame, holidays: DataFrame) -> DataFrame:
    """Counts per zone and hour with weather, calendar and borough.

    The trips are counted first, so the joins see one row per zone and hour.
    """
    return describe_hours(hourly_counts(trips), zones, hourly, holidays)


def describe_hours(counts: DataFrame, zones: DataFrame, hourly: DataFrame, holidays: DataFrame) -> DataFrame:
    """Weather, calendar and borough of rows with ``zone_id`` and ``hour_ts``."""
    demand = add_calendar(counts)
    demand = join_weather(demand, hourly, ts="hour_ts").drop("weather_ts")
    demand = flag_holidays(demand, holidays, date="date")
    boroughs = zones.select(F.col("LocationID").try_cast("bigint").alias("id"), F.col("Borough").alias("borough"))
    return lookup_join(demand, boroughs, {"zone_id": "id"}, salts=1)


def fill_hours(demand: DataFrame) -> DataFrame:
    """Every hour between a zone's first and last one; hours without trips count 0."""
    bounds = demand.groupBy("zone_id").agg(F.min("hour_ts").alias("first"), F.max("hour_ts").alias("last"))
    hours = F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))
    spine = bounds.select("zone_id", F.explode(hours).alias("hour_ts"), F.lit(0).cast("bigint").alias("trip_count"))
    counts = demand.select("zone_id", "hour_ts", "trip_count").unionByName(spine)
    return counts.groupBy("zone_id", "hour_ts").agg(F.sum("trip_count").alias("trip_count"))


def add_history(
    demand: DataFrame,
    lags: tuple[int, ...] = LAGS,
    spans: tuple[int, ...] = SPANS,
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Trips some hours earlier (``lag_Nh``) and mean trips of the hours before (``rolling_mean_Nh``).

    Frames run over the hour number, so a missing hour gives NULL and never an older value; the
    current hour is outside every frame. Means are over the hours present: fill the hours first
    to count the missing ones as 0. A zone's timeline is cut into blocks, and the hours that the
    next block looks back on are repeated there, so a task sorts a bounded stretch of a zone.
    """
    reach = max(*lags, *spans)
    size = max(block_hours, reach)
    number = F.col("_hour_no")
    block = F.floor(number / size)
    near_end = F.pmod(number, F.lit(size)) >= size - reach
    placed = (
        demand.withColumn("_hour_no", epoch_hour("hour_ts"))
        .withColumn("_own", block)
        .withColumn("_block", F.explode(
            F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))
        ))
    )
    timeline = Window.partitionBy("zone_id", "_block").orderBy("_hour_no")

    def earlier(hours: int) -> Column:
        return F.max("trip_count").over(timeline.rangeBetween(-hours, -hours))

    def mean_before(hours: int) -> Column:
        return F.avg("trip_count").over(timeline.rangeBetween(-hours, -1))

    history = {f"lag_{n}h": earlier(n) for n in lags}
    history |= {f"rolling_mean_{n}h": mean_before(n) for n in spans}
    return placed.withColumns(history).filter(F.col("_own") == F.col("_block")).drop("_hour_no", "_own", "_block")


def zone_profiles(trips: DataFrame) -> DataFrame:
    """Share of each hour of the day in a zone's trips: ``zone_id, trips, h00 .. h23``."""
    hour = F.hour("pickup_ts")
    total = F.count(F.lit(1))
    return trips.groupBy(F.col("pu_location_id").alias("zone_id")).agg(
        total.alias("trips"),
        *((F.count_if(hour == h) / total).alias(f"h{h:02d}") for h in range(24)),
    )
