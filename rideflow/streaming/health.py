"""Live model health: predictions joined with the trips' outcomes as these arrive, measured per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_outcomes(
    predictions: DataFrame, outcomes: DataFrame, keys: Sequence[str], within: str = "6 hours", late: str = "15 minutes"
) -> DataFrame:
    """Predictions with the outcome of their trip, which comes within a time after them; null where none came.

    ``predictions`` has the keys and ``predicted_at``, ``outcomes`` the keys and ``finished_at``. As streams, both are kept
    until the watermark has passed the time that an outcome may take, so a row without outcome comes when that time is over.
    Rows of a null key join nothing, and outcomes of one do not move the watermark.
    """
    if predictions.isStreaming:
        predictions, outcomes = predictions.withWatermark("predicted_at", late), outcomes.withWatermark("finished_at", late)
    named = outcomes.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key) == F.col(f"_{key}") for key in keys]
    after = (F.col("finished_at") >= F.col("predicted_at")) & (F.col("finished_at") <= F.col("predicted_at") + F.expr(f"INTERVAL {within}"))
    for part in same:
        after = after & part
    return predictions.join(named, after, "leftOuter").drop(*(f"_{key}" for key in keys))


def health_by_window(joined: DataFrame, label: str, prediction: str, length: str = "1 hour") -> DataFrame:
    """``window_start, window_end, predictions, finished, rmse, mae`` per window of the predictions' time."""
    error = (F.col(label) - F.col(prediction)).cast("double")
    measured = joined.groupBy(F.window("predicted_at", length)).agg(
        F.count(F.lit(1)).alias("predictions"), F.count(error).alias("finished"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
    )
    return measured.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "predictions", "finished", "rmse", "mae")
