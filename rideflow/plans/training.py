"""Fare and duration models from processed trips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.ml.features import BOOKING_FEATURES, TRIP_FEATURES, assembler, check_inputs, flag_leakage
from rideflow.ml.models import GBT_DEPTH, GBT_ITERATIONS, evaluate, fit, gbt, save
from rideflow.operators.encoding import ZoneMeans, encode_zones, zone_means
from rideflow.operators.features import add_training_features, within_training_bounds
from rideflow.operators.splits import keyed_split

TASKS = {"fare": "fare_amount", "eta": "trip_duration_min"}
# The whole amount paid may be asked for too; it is not among the default tasks.
TARGETS = {**TASKS, "total": "total_amount"}
SPLIT_KEYS = ("pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id")


@dataclass(frozen=True)
class TrainingData:
    """Assembled rows of both parts, and what is needed to prepare further rows."""

    train: DataFrame
    test: DataFrame
    means: ZoneMeans
    distance: DataFrame
    features: tuple[str, ...]


@dataclass(frozen=True)
class Trained:
    models: dict[str, Model]
    metrics: DataFrame
    data: TrainingData


def training_data(
    trips: DataFrame,
    booking_time_only: bool = False,
    reference_calendar: bool = False,
    leave_one_out: bool = False,
    split=None,
) -> TrainingData:
    """Bounded trips, split before the zones are encoded, as feature vectors.

    ``booking_time_only`` takes the centroid distance in place of the metered one; trips without
    it get the training mean. ``split`` maps rows to (train, test); the default is 80 to 20 by a
    hash of the trip, which does not depend on the partitioning.
    """
    features = BOOKING_FEATURES if booking_time_only else TRIP_FEATURES
    distance_column = features[0]
    if booking_time_only:
        for label in TARGETS.values():
            check_inputs(features, label)
    bounded = within_training_bounds(trips)
    train, test = split(bounded) if split else keyed_split(bounded, SPLIT_KEYS)
    distance = train.agg(F.avg(distance_column).alias("mean_distance"))
    means = zone_means(train)

    def prepare(rows: DataFrame, own: bool) -> DataFrame:
        if booking_time_only:
            rows = rows.withColumn(distance_column, F.coalesce(distance_column, distance.scalar()))
        rows = add_training_features(rows, reference_calendar, distance_column)
        return assembler(features).transform(encode_zones(rows, means, leave_one_out and own))

    return TrainingData(prepare(train, True), prepare(test, False), means, distance, features)


def train_models(
    trips: DataFrame,
    out_path: str | None = None,
    iterations: int = GBT_ITERATIONS,
    depth: int = GBT_DEPTH,
    tasks: tuple[str, ...] = tuple(TASKS),
    **options,
) -> Trained:
    """Boosted trees for each task (``fare``, ``eta``; ``total`` if asked for), measured on the test part, saved below ``out_path``.

    The training vectors are kept on memory and disk, since each boosting round reads them. Rows without a label train no model of it.
    """
    data = training_data(trips, **options)
    labels = [TARGETS[task] for task in tasks]
    train = data.train.select("features", *labels).persist(StorageLevel.MEMORY_AND_DISK)
    models, measures = {}, None
    for task, label in zip(tasks, labels):
        models[task] = fit(gbt(label, iterations, depth), train.filter(F.col(label).isNotNull()))
        row = evaluate(models[task].transform(data.test), task, label)
        measures = row if measures is None else measures.unionByName(row)
        if out_path:
            save(models[task], f"{out_path}/{task}_gbt")
    train.unpersist()
    return Trained(models, flag_leakage(measures), data)
