"""Scoring of ride requests and the health of deployed models."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.ml.intervals import residual_sketches, with_range
from rideflow.operators.baselines import regression_metrics
from rideflow.operators.encoding import ZoneMeans, encode_zones
from rideflow.operators.enrich import join_centroids
from rideflow.operators.features import add_training_features
from rideflow.session import materialize


def request_features(requests: DataFrame, centroids: DataFrame, means: ZoneMeans, distance: DataFrame) -> DataFrame:
    """Booking-time inputs of requests with ``pu_location_id, do_location_id, pickup_ts``.

    ``distance`` is a one-row frame with the ``mean_distance`` that stands in where a zone has no centroid.
    """
    placed = join_centroids(requests, centroids)
    known = F.coalesce("centroid_distance_mi", distance.select("mean_distance").scalar())
    dated = placed.withColumns({
        "centroid_distance_mi": known,
        "pickup_hour": F.hour("pickup_ts"),
        "pickup_dayofweek": F.dayofweek("pickup_ts"),
    })
    return encode_zones(add_training_features(dated, distance="centroid_distance_mi"), means)


def score_requests(inputs: DataFrame, fare_model: Model, eta_model: Model) -> DataFrame:
    """Predicted fare and minutes beside each request."""
    scored = fare_model.transform(inputs).withColumnRenamed("prediction", "predicted_fare")
    scored = eta_model.transform(scored).withColumnRenamed("prediction", "predicted_minutes")
    return scored.drop("features")


#: Groups of residuals, from the finest on.
RANGE_LEVELS = (("pu_location_id", "do_location_id", "pickup_hour", "is_rainy"), ("pickup_hour", "is_rainy"), ("pickup_hour",), ())


def request_ranges(scored: DataFrame, calibration: DataFrame) -> DataFrame:
    """Scored requests with ``fare_low``, ``fare_high``, ``minutes_low`` and ``minutes_high``; none is below 0.

    ``calibration`` are scored trips that the models were not fitted on, with the groups of ``RANGE_LEVELS``.
    """
    for label, prediction, name in (("fare_amount", "predicted_fare", "fare"), ("trip_duration_min", "predicted_minutes", "minutes")):
        sketches = materialize(residual_sketches(calibration, label, prediction, RANGE_LEVELS[0]))
        ranged = with_range(scored, prediction, sketches, RANGE_LEVELS, floor=0.0)
        scored = ranged.drop("level").withColumnsRenamed({"low": f"{name}_low", "high": f"{name}_high"})
    return scored


def model_health(scored: DataFrame, label: str, prediction: str = "prediction", ts: str = "pickup_ts", period: str = "month") -> DataFrame:
    """Measures per day, week or month of the scored trips."""
    dated = scored.withColumn("period", F.date_trunc(period, ts))
    return regression_metrics(dated, label, prediction, ("period",))
