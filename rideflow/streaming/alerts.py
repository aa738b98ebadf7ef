"""Surge alerts: demand above the forecast in two adjacent windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD = 2.0


def surge_alerts_stream(rated: DataFrame, threshold: float = THRESHOLD, minutes: int = 10) -> DataFrame:
    """Alerts from a stream of tumbling windows with ``surge_ratio``.

    A second window, twice as long and moved by one window, counts the hot windows in it: two
    of two is an alert. Works in append mode, so an alert comes when both windows are closed.
    """
    hot = F.col("surge_ratio") > threshold
    pair = F.window(F.window_time("window"), f"{2 * minutes} minutes", f"{minutes} minutes")
    return (
        rated.filter(hot)
        .groupBy(pair.alias("pair"), "PULocationID")
        .agg(F.count(F.lit(1)).alias("hot_windows"), F.max("surge_ratio").alias("peak_ratio"))
        .filter(F.col("hot_windows") == 2)
        .select(
            F.col("pair.start").alias("alert_start"),
            F.col("pair.end").alias("alert_end"),
            "PULocationID",
            "peak_ratio",
        )
    )


def surge_alerts_batch(rated: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The same alerts over finished windows: each hot window looks at the one before it.

    Only hot windows are kept before the shuffle, and a zone's time is cut by day, with the last
    window of a day repeated in the next, so no task holds all windows of a zone.
    """
    start = F.col("window.start")
    hot = rated.filter(F.col("surge_ratio") > threshold).select(
        "PULocationID", "surge_ratio", start.alias("start"), F.col("window.end").alias("end")
    )
    days = F.array_distinct(F.array(F.to_date("start"), F.to_date("end")))
    placed = hot.withColumn("day", F.explode(days))
    timeline = Window.partitionBy("PULocationID", "day").orderBy("start")
    paired = placed.withColumns({
        "before_start": F.lag("start").over(timeline),
        "before_end": F.lag("end").over(timeline),
        "before_ratio": F.lag("surge_ratio").over(timeline),
    })
    adjacent = (F.col("before_end") == F.col("start")) & (F.to_date("start") == F.col("day"))
    return paired.filter(adjacent).select(
        F.col("before_start").alias("alert_start"),
        F.col("end").alias("alert_end"),
        "PULocationID",
        F.greatest("surge_ratio", "before_ratio").alias("peak_ratio"),
    )
