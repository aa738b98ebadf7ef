"""Regressors, their comparison with baselines, tuning on a validation period, and persistence."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rideflow.operators.baselines import BASELINE, regression_metrics
from rideflow.session import ensure_checkpoints

# Size of the trip models.
GBT_ITERATIONS, GBT_DEPTH, SEED = 100, 10, 42


def gbt(label: str, iterations: int = GBT_ITERATIONS, depth: int = GBT_DEPTH, **params: Any) -> GBTRegressor:
    """Boosted trees; node ids are cached and the chain of rounds is cut by checkpoints."""
    settings = {"seed": SEED, "cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 512, **params}
    return GBTRegressor(labelCol=label, featuresCol="features", maxIter=iterations, maxDepth=depth, **settings)


def forest(label: str, trees: int = 20, depth: int = 10, **params: Any) -> RandomForestRegressor:
    settings = {"seed": SEED, "maxMemoryInMB": 512, **params}
    return RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, **settings)


def linear(label: str, **params: Any) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol="features", **params)


def algorithms(label: str, iterations: int = 20, trees: int = 20, depth: int = 5) -> dict[str, Estimator]:
    """The three algorithms that are compared for each task."""
    return {
        "linear_regression": linear(label),
        "random_forest": forest(label, trees, depth),
        "gbt": gbt(label, iterations, depth),
    }


def fit(estimator: Estimator, train: DataFrame) -> Model:
    """Fit with a checkpoint folder in place, which long boosting runs need."""
    ensure_checkpoints(train.sparkSession)
    return estimator.fit(train)


def evaluate(
    scored: DataFrame, task: str, label: str, predictions: Mapping[str, str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row of measures per model, from one pass; ``predictions`` maps model names to columns."""
    predictions = predictions or {"gbt": "prediction"}
    guesses = [F.col(column).cast("double").alias(model) for model, column in predictions.items()]
    long = scored.select(*by, label, *guesses).unpivot([*by, label], list(predictions), "model", "prediction")
    measured = regression_metrics(long, label, "prediction", ("model", *by))
    return measured.select(F.lit(task).alias("task"), *measured.columns)


def compare(
    task: str, label: str, estimators: Mapping[str, Estimator], train: DataFrame, test: DataFrame, baseline: str
) -> tuple[DataFrame, dict[str, Model]]:
    """Fit each estimator and measure it and the ``baseline`` column of the test rows.

    The training rows carry assembled ``features``; they are kept while the estimators read them.
    The test rows are scored by all models in one pass. ``beats_baseline`` compares the root mean
    squared errors.
    """
    kept = train.select("features", label).persist(StorageLevel.MEMORY_AND_DISK)
    models = {name: fit(estimator, kept) for name, estimator in estimators.items()}
    kept.unpersist()
    scored = test
    for name, model in models.items():
        scored = model.transform(scored).withColumnRenamed("prediction", name)
    predictions = {BASELINE: baseline, **{name: name for name in models}}
    return against_baseline(evaluate(scored, task, label, predictions)), models


def against_baseline(table: DataFrame) -> DataFrame:
    """Join each model's measures to those of the baseline of its task; one row per task and model."""
    floor = table.filter(F.col("model") == BASELINE).select("task", F.col("rmse").alias("baseline_rmse"))
    return table.join(floor, "task", "left").withColumn("beats_baseline", F.col("rmse") < F.col("baseline_rmse"))


def tune(
    estimator: Estimator, grid: Sequence[Mapping[str, Any]], train: DataFrame, validation: DataFrame, label: str
) -> tuple[DataFrame, Model]:
    """Fit each setting on the training period and score it on the later validation period.

    Returns the measures of all settings and the model of least error.
    """
    spark = train.sparkSession
    train, validation = (rows.select("features", label).persist(StorageLevel.MEMORY_AND_DISK) for rows in (train, validation))
    results, best, best_model = [], float("inf"), None
    for number, setting in enumerate(grid):
        candidate = estimator.copy({estimator.getParam(name): value for name, value in setting.items()})
        model = fit(candidate, train)
        measures = regression_metrics(model.transform(validation), label, "prediction").first()
        text = ", ".join(f"{name}={value}" for name, value in setting.items())
        results.append((number, text, measures.rows, measures.rmse, measures.mae, measures.r2))
        if measures.rmse < best:
            best, best_model = measures.rmse, model
    train.unpersist()
    validation.unpersist()
    schema = "setting int, params string, rows bigint, rmse double, mae double, r2 double"
    table = spark.createDataFrame(results, schema)
    return table.withColumn("chosen", F.col("rmse") == best), best_model


def walk_forward(
    estimator: Estimator, grid: Sequence[Mapping[str, Any]], folds: Sequence[Callable[[], tuple[DataFrame, DataFrame]]], label: str
) -> DataFrame:
    """Fit each setting on each fold and rank the settings by their mean error over the folds.

    A fold is a function that gives its training and validation rows with ``features``. A row per setting and fold: ``setting,
    params, fold, rows, rmse, mae, r2``, and for the setting ``mean_rmse``, ``rank`` (equal means: the earlier one first) and ``chosen``.
    A setting without a measure in some fold comes last.
    """
    results = []
    for number, fold in enumerate(folds):
        train, validation = (rows.select("features", label).persist(StorageLevel.MEMORY_AND_DISK) for rows in fold())
        for place, setting in enumerate(grid):
            candidate = estimator.copy({estimator.getParam(name): value for name, value in setting.items()})
            measures = regression_metrics(fit(candidate, train).transform(validation), label, "prediction").first()
            text = ", ".join(f"{name}={value}" for name, value in setting.items())
            results.append((place, text, number, measures.rows, measures.rmse, measures.mae, measures.r2))
        train.unpersist()
        validation.unpersist()
    schema = "setting int, params string, fold int, rows bigint, rmse double, mae double, r2 double"
    return ranked_settings(SparkSession.active().createDataFrame(results, schema))


def ranked_settings(results: DataFrame) -> DataFrame:
    """Measures by ``setting`` and ``fold`` with the setting's ``mean_rmse``, ``rank`` and whether it is ``chosen``."""
    means = results.groupBy("setting").agg(F.when(F.count("rmse") == F.count(F.lit(1)), F.avg("rmse")).alias("mean_rmse"))
    # A row per setting of the grid.
    order = Window.orderBy(F.col("mean_rmse").asc_nulls_last(), "setting")
    ranked = means.withColumn("rank", F.row_number().over(order))
    return results.join(ranked, "setting").withColumn("chosen", F.col("rank") == 1)


def feature_importance(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Importance of each input of a tree model, highest first."""
    trees = model.stages[-1] if isinstance(model, PipelineModel) else model
    weights = trees.featureImportances.toArray().tolist()
    rows = list(zip(names, weights, strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def load_pipeline(path: str) -> PipelineModel:
    """A saved pipeline, ready to score a table or a stream."""
    return PipelineModel.load(path)


def save(model: Model, path: str) -> None:
    """Replace the saved model at ``path``."""
    model.write().overwrite().save(path)
