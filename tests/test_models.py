from __future__ import annotations

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from rideflow.ml import clusters, models
from rideflow.ml.features import BOOKING_FEATURES, TRIP_FEATURES, assembler, check_inputs, flag_leakage, preparation, vector_names
from rideflow.operators.baselines import regression_metrics
from rideflow.operators.encoding import encode_zones, zone_means
from rideflow.operators.splits import random_split
from rideflow.plans.training import train_models, training_data
from workload import queries as q


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return q.featured(spark, sf_dir).cache()


def rows(spark, *values):
    return spark.createDataFrame(
        list(values), "pu_location_id bigint, do_location_id bigint, fare_amount double, trip_duration_min double"
    )


def test_unseen_zones_get_the_overall_mean(spark):
    means = zone_means(rows(spark, (1, 2, 10.0, 5.0), (1, 3, 20.0, 15.0)))
    coded = encode_zones(rows(spark, (1, 9, 0.0, 0.0), (8, 3, 0.0, 0.0)), means).orderBy("pu_location_id").collect()
    assert [(r.pu_fare_mean, r.do_fare_mean, r.pu_eta_mean, r.do_eta_mean) for r in coded] == [
        (15.0, 15.0, 10.0, 10.0),
        (15.0, 20.0, 10.0, 15.0),
    ]


def test_leave_one_out(spark):
    train = rows(spark, (1, 2, 10.0, 5.0), (1, 3, 20.0, 15.0))
    coded = encode_zones(train, zone_means(train), leave_one_out=True).orderBy("fare_amount").collect()
    assert [r.pu_fare_mean for r in coded] == [20.0, 10.0]
    assert [r.do_fare_mean for r in coded] == [15.0, 15.0]
    assert coded[0].asDict().keys() == set(train.columns) | {"pu_fare_mean", "do_fare_mean", "pu_eta_mean", "do_eta_mean"}


def test_metrics(spark):
    scored = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 1.0), (5.0, None)], "y double, p double")
    row = regression_metrics(scored, "y", "p").first()
    assert row["rows"] == 3 and row.mae == pytest.approx(2 / 3) and row.rmse == pytest.approx((2 / 3) ** 0.5)
    assert row.r2 == pytest.approx(1 - 2 / (14 / 3)) and row.mape == pytest.approx(50.0)


def test_leakage_guard(spark):
    check_inputs(BOOKING_FEATURES, "fare_amount")
    with pytest.raises(ValueError, match="trip_distance_mi"):
        check_inputs(TRIP_FEATURES, "fare_amount")
    with pytest.raises(ValueError, match="x"):
        check_inputs(["x"], "x")
    flagged = flag_leakage(spark.createDataFrame([(0.99,), (0.5,), (None,)], "r2 double")).collect()
    assert [r.suspicious for r in flagged] == [True, False, False]


def test_training_saves_models_that_load(spark, trips, tmp_path):
    trained = train_models(trips, str(tmp_path), iterations=2, depth=3)
    assert {r.task for r in trained.metrics.collect()} == {"fare", "eta"}
    loaded = GBTRegressionModel.load(str(tmp_path / "fare_gbt"))
    assert loaded.getNumTrees == 2
    assert loaded.transform(trained.data.test).filter(F.col("prediction").isNull()).isEmpty()


def test_training_data_covers_the_bounded_trips(trips):
    data = training_data(trips)
    bounded = trips.filter(
        "trip_distance_mi > 0.1 AND trip_distance_mi < 50 AND fare_amount BETWEEN 2.5 AND 150 AND trip_duration_min BETWEEN 1 AND 120"
    )
    assert data.train.count() + data.test.count() == bounded.count()
    assert data.train.first().features.size == 12


def test_split_may_be_random(trips):
    data = training_data(trips, split=random_split)
    train, test = data.train.count(), data.test.count()
    assert 0.7 < train / (train + test) < 0.9


def test_comparison_has_one_row_per_model(spark, trips):
    data = training_data(trips)
    test = data.test.withColumn("guess", F.lit(50.0))
    table, fitted = models.compare("fare", "fare_amount", models.algorithms("fare_amount", 2, 2, 3), data.train, test, "guess")
    assert {r.model for r in table.collect()} == {"baseline", *fitted}
    assert table.filter("model = 'baseline' AND beats_baseline").isEmpty()


def test_tuning_picks_the_least_error(spark, trips):
    data = training_data(trips)
    grid = [{"maxDepth": 1, "numTrees": 1}, {"maxDepth": 4, "numTrees": 5}]
    train, validation = data.train.randomSplit([0.8, 0.2], 1)
    table, model = models.tune(models.forest("fare_amount"), grid, train, validation, "fare_amount")
    best = min(table.collect(), key=lambda r: r.rmse)
    assert best.chosen and table.filter("chosen").count() == 1
    assert model.getNumTrees == grid[best.setting]["numTrees"]


def test_prepared_vectors_know_their_names(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, 4.0, "b"), (5.0, 1.0, "a")], "x double, y double, c string")
    made = preparation(["x", "y"], ["c"]).fit(df).transform(df)
    assert vector_names(made, "assembled")[:2] == ["x", "y"] and made.first().features.size == 4


def test_clusters_separate_different_days(spark):
    day = [1 / 6 if 9 <= h < 15 else 0.0 for h in range(24)]
    night = [1 / 6 if h < 6 else 0.0 for h in range(24)]
    data = [(n, *(x + n / 1e4 for x in (day if n % 2 else night))) for n in range(12)]
    schema = "zone_id bigint, " + ", ".join(f"{c} double" for c in clusters.PROFILE)
    vectors = clusters.profile_vectors(spark.createDataFrame(data, schema))
    table, model = clusters.choose_k(vectors, (2, 3))
    assert table.filter("chosen").first().k == 2
    groups = {r.zone_id: r.cluster for r in clusters.assign_clusters(vectors, model).collect()}
    assert len({groups[n] for n in range(0, 12, 2)}) == 1 and groups[0] != groups[1]


def test_importances_sum_to_one(spark, trips):
    vectors = assembler(["trip_distance_mi", "pickup_hour"]).transform(trips)
    model = models.fit(models.gbt("fare_amount", 2, 3), vectors)
    table = models.feature_importance(spark, model, ["trip_distance_mi", "pickup_hour"])
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_registered_models_take_their_size_from_the_session(spark):
    small = q._compared(spark, "y"), q._tuning_grid(spark)
    settings = {"rideflow.models.rounds": "7", "rideflow.models.depth": "6", "rideflow.models.trees": "9"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        large = q._compared(spark, "y"), q._tuning_grid(spark)
        assert q._model_size(spark, 3, 4) == {"iterations": 7, "depth": 6}
    finally:
        for key in settings:
            spark.conf.unset(key)
    sizes = lambda x: (x["gbt"].getMaxIter(), x["gbt"].getMaxDepth(), x["random_forest"].getNumTrees(), x["random_forest"].getMaxDepth())
    assert (sizes(small[0]), sizes(large[0])) == ((3, 4, 5, 4), (7, 6, 9, 6))
    assert [(g["maxDepth"], g["numTrees"]) for g in small[1]] == [(3, 3), (3, 6), (5, 3), (5, 6)]
    assert [(g["maxDepth"], g["numTrees"]) for g in large[1]] == [(4, 4), (4, 9), (6, 4), (6, 9)]
