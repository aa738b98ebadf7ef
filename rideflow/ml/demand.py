"""Hourly demand models on lags, rolling means, calendar, weather and zone cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.columns import hour_angle
from rideflow.operators.analysis import top_k
from rideflow.operators.demand import LAGS, SPANS, fill_hours
from rideflow.operators.lookup import lookup_join

MEANS = tuple(f"rolling_mean_{n}h" for n in SPANS)
HISTORY = (*(f"lag_{n}h" for n in LAGS), *MEANS)
WEATHER = ("temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct")
DEMAND_FEATURES = (*HISTORY, *WEATHER, "sin_hour", "cos_hour", "dayofweek", "is_weekend", "is_holiday", "is_rainy")
DEMAND_CATEGORIES = ("cluster",)


def demand_features(history: DataFrame, clusters: DataFrame) -> DataFrame:
    """Model rows of a demand table with history columns: no NULL inputs, cluster as text.

    An hour without trips counted 0, so a missing lag or mean is 0; a missing reading is 0 too.
    """
    rows = lookup_join(history, clusters, {"zone_id": "zone_id"}, salts=1)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in (*HISTORY, *WEATHER, "is_rainy")}
    return rows.withColumns(filled).withColumns({
        "sin_hour": F.sin(hour_angle("hour")),
        "cos_hour": F.cos(hour_angle("hour")),
        "cluster": F.coalesce(F.col("cluster").cast("string"), F.lit("none")),
    })


def with_next_hour(counts: DataFrame) -> DataFrame:
    """Hourly counts of every zone up to the hour after the last one of all zones, whose count is unknown (NULL).

    Hours without trips count 0. With ``add_history`` the unknown hour gets lags and means as any
    other, so it can be scored before it has happened.
    """
    last = counts.agg(F.max("hour_ts")).scalar()
    ahead = counts.select("zone_id").distinct().select(
        "zone_id", (last + F.expr("INTERVAL 1 HOUR")).alias("hour_ts"), F.lit(0).cast("bigint").alias("trip_count")
    )
    filled = fill_hours(counts.unionByName(ahead))
    return filled.withColumn("trip_count", F.when(F.col("hour_ts") <= last, F.col("trip_count")))


def next_hour_top(scored: DataFrame, k: int = 5) -> DataFrame:
    """The zones of highest predicted demand in the latest hour that is scored."""
    latest = scored.agg(F.max("hour_ts")).scalar()
    return top_k(scored.filter(F.col("hour_ts") == latest), "prediction", "zone_id", k)
