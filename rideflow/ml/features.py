"""Model inputs and the guard against columns that are known only after a trip."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.operators.encoding import ENCODED

# Inputs of the trip models, in vector order.
TRIP_FEATURES = (
    "trip_distance_mi", "log_distance",
    "sin_hour", "cos_hour",
    "is_weekend", "is_rush_hour", "is_evening_night", "is_airport",
    *ENCODED,
)
# The same with the centroid distance, which is known at booking time.
BOOKING_FEATURES = ("centroid_distance_mi", *TRIP_FEATURES[1:])
AFTER_TRIP = frozenset({
    "trip_duration_min", "avg_speed_mph", "tip_amount", "tolls_amount", "total_amount", "fare_amount",
    "fare_per_mile", "trip_distance_mi", "dropoff_ts",
})
SUSPICIOUS_R2 = 0.98


def check_inputs(columns: Iterable[str], label: str) -> None:
    """Raise when a booking-time model would see a column known only after the trip, or its label."""
    leaking = sorted(set(columns) & (AFTER_TRIP | {label}))
    if leaking:
        raise ValueError(f"columns not known at booking time: {', '.join(leaking)}")


def flag_leakage(metrics: DataFrame, limit: float = SUSPICIOUS_R2) -> DataFrame:
    """Mark models that are too good to be true."""
    return metrics.withColumn("suspicious", F.coalesce(F.col("r2") > limit, F.lit(False)))


def assembler(columns: Iterable[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def preparation(numeric: Iterable[str], categorical: Iterable[str] = (), scale: bool = True) -> Pipeline:
    """Index, one-hot, assemble and scale; unseen categories get their own slot."""
    stages, encoded = [], []
    for column in categorical:
        stages.append(StringIndexer(inputCol=column, outputCol=f"{column}_index", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{column}_index", outputCol=f"{column}_vector"))
        encoded.append(f"{column}_vector")
    assembled = "assembled" if scale else "features"
    stages.append(assembler([*numeric, *encoded], assembled))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=False, withStd=True))
    return Pipeline(stages=stages)


def vector_names(scored: DataFrame, column: str = "features") -> list[str]:
    """Input name of each slot of an assembled vector, from its column metadata."""
    groups = scored.schema[column].metadata["ml_attr"]["attrs"]
    slots = [slot for group in groups.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda slot: slot["idx"])]
