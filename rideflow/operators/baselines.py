"""Predictions without a model, and the measures that compare them with one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.operators.lookup import lookup_join

BASELINE = "baseline"


def demand_baseline(train: DataFrame) -> DataFrame:
    """Mean trips per zone, hour and day of week over the hours of the training demand."""
    return train.groupBy("zone_id", "hour", "dayofweek").agg(F.avg("trip_count").alias("baseline_trips"))


def apply_demand_baseline(rows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Join the expected trips to rows that carry zone, hour and day of week."""
    keys = {key: key for key in ("zone_id", "hour", "dayofweek")}
    return lookup_join(rows, baseline, keys, salts=1)


def dollars_per_mile(train: DataFrame, label: str = "fare_amount", distance: str = "trip_distance_mi") -> Column:
    """All dollars over all miles, as a value for other frames; a trip of no distance does no harm."""
    both = train.filter(F.col(label).isNotNull() & F.col(distance).isNotNull())
    return both.agg(F.try_divide(F.sum(label), F.sum(distance))).scalar()


def mean_speed(train: DataFrame, minutes: str = "trip_duration_min", distance: str = "trip_distance_mi") -> Column:
    """All miles over all hours, as a value for other frames."""
    both = train.filter(F.col(minutes).isNotNull() & F.col(distance).isNotNull())
    return both.agg(F.try_divide(F.sum(distance), F.sum(minutes) / 60.0)).scalar()


def fare_baseline(rows: DataFrame, train: DataFrame, distance: str = "trip_distance_mi") -> DataFrame:
    """Distance times the dollars per mile of the training trips."""
    return rows.withColumn("baseline_fare", F.col(distance) * dollars_per_mile(train, distance=distance))


def eta_baseline(rows: DataFrame, train: DataFrame, distance: str = "trip_distance_mi") -> DataFrame:
    """Distance over the speed of the training trips."""
    hours = F.try_divide(F.col(distance), mean_speed(train, distance=distance))
    return rows.withColumn("baseline_minutes", hours * 60.0)


def trip_baselines(rows: DataFrame, train: DataFrame, distance: str = "trip_distance_mi") -> DataFrame:
    """Both trip baselines, ``baseline_fare`` and ``baseline_minutes``; the rates come from one pass over the training trips."""
    miles, fare, minutes = (F.col(c) for c in (distance, "fare_amount", "trip_duration_min"))
    paid, timed = miles.isNotNull() & fare.isNotNull(), miles.isNotNull() & minutes.isNotNull()
    rates = train.agg(
        F.try_divide(F.sum(F.when(paid, fare)), F.sum(F.when(paid, miles))).alias("dollars"),
        F.try_divide(F.sum(F.when(timed, miles)), F.sum(F.when(timed, minutes)) / 60.0).alias("speed"),
    ).first()
    dollars, speed = (F.lit(rate).cast("double") for rate in rates)
    return rows.withColumns({"baseline_fare": miles * dollars, "baseline_minutes": F.try_divide(miles, speed) * 60.0})


def task_metrics(scored: DataFrame, tasks: dict[str, tuple[str, str]], by: tuple[str, ...] = ()) -> DataFrame:
    """``regression_metrics`` of several tasks, ``{task: (label, prediction)}``, from one pass over the rows."""
    pairs = [
        F.struct(F.lit(task).alias("task"), F.col(label).cast("double").alias("y"), F.col(guess).cast("double").alias("p"))
        for task, (label, guess) in tasks.items()
    ]
    return regression_metrics(scored.select(*by, F.inline(F.array(*pairs))), "y", "p", ("task", *by))


def regression_metrics(scored: DataFrame, label: str, prediction: str, by: tuple[str, ...] = ()) -> DataFrame:
    """RMSE, MAE, R2 and MAPE in one aggregation; rows without a prediction are left out.

    MAPE leaves out labels of 0.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    rows = F.count(F.lit(1))
    return (
        scored.filter(y.isNotNull() & p.isNotNull())
        .groupBy(*by)
        .agg(
            rows.alias("rows"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            (1.0 - F.try_divide(F.sum(error * error), F.var_pop(y) * rows)).alias("r2"),
            (F.avg(F.try_divide(F.abs(error), F.abs(y))) * 100.0).alias("mape"),
        )
    )
