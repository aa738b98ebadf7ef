"""How far predictions are off, as tables: distribution of residuals and measures by zone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.operators.baselines import task_metrics


def residual_distribution(scored: DataFrame, label: str, predictions: Mapping[str, str], width: float = 5.0) -> DataFrame:
    """Rows per band of residual (label less prediction) and model: ``model, low, high, rows, share``.

    A band holds residuals from ``low`` up to but not including ``high``; bands without rows are left out, and so are rows without
    label or prediction. ``predictions`` maps model names to columns; all are counted in one pass.
    """
    pairs = [F.struct(F.lit(model).alias("model"), (F.col(label) - F.col(column)).alias("residual")) for model, column in predictions.items()]
    known = scored.select(F.inline(F.array(*pairs))).filter("residual IS NOT NULL")
    counted = known.groupBy("model", F.floor(F.col("residual") / F.lit(width)).alias("band")).agg(F.count(F.lit(1)).alias("rows"))
    # A row per model and band.
    totals = counted.groupBy("model").agg(F.sum("rows").alias("total"))
    low = F.col("band") * F.lit(width)
    return counted.join(totals, "model").select("model", low.alias("low"), (low + F.lit(width)).alias("high"), "rows", (F.col("rows") / F.col("total")).alias("share"))


def error_by_zone(scored: DataFrame, tasks: Mapping[str, tuple[str, str]], zone: str = "pu_location_id", min_rows: int = 1) -> DataFrame:
    """Measures per task and zone with the mean residual as ``bias``; zones of fewer than ``min_rows`` trips are left out.

    ``tasks`` is ``{task: (label, prediction)}``; a prediction above the label makes a negative bias.
    """
    measured = task_metrics(scored, dict(tasks), (zone,)).filter(F.col("rows") >= min_rows)
    pairs = [F.struct(F.lit(task).alias("task"), (F.col(label) - F.col(guess)).alias("residual")) for task, (label, guess) in tasks.items()]
    biased = scored.select(zone, F.inline(F.array(*pairs))).groupBy("task", zone).agg(F.avg("residual").alias("bias"))
    same = (F.col("m.task") == F.col("b.task")) & F.col(f"m.{zone}").eqNullSafe(F.col(f"b.{zone}"))
    return measured.alias("m").join(biased.alias("b"), same).select("m.*", "b.bias")
